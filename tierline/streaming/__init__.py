"""Incremental file ingestion (Structured Streaming, run to completion) and
declared streaming datasets."""
