"""Column-level helpers (all built-in Spark expressions, no Python UDFs)."""

from tierline.functions.casting import cast_failures, conform, parse_date, typed
from tierline.functions.hashing import concat_hash, row_hash
from tierline.functions.rules import band, metric_column
from tierline.functions.text import json_field, render_template, row_text, xml_field

__all__ = [
    "band",
    "cast_failures",
    "concat_hash",
    "conform",
    "json_field",
    "metric_column",
    "parse_date",
    "render_template",
    "row_hash",
    "row_text",
    "typed",
    "xml_field",
]
