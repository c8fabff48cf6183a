"""Sources and tables: file readers and writers with lineage, persisted schemas,
versioned parquet tables, the SCD2 dimension store and append-only logs."""
