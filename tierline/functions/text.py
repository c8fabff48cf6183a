"""Text helpers: nested JSON / XML fields kept as text, prompt templates, row text."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(c: Column | str, path: str) -> Column:
    """Field of a JSON text column; invalid JSON or a missing path → NULL."""
    return F.get_json_object(_col(c), path)


def xml_field(c: Column | str, tag: str) -> Column:
    """Text of the first ``<tag>…</tag>`` inside an XML text column.

    A missing tag is NULL (``regexp_extract`` alone would give ``''``). The
    pattern is dot-all so a value spanning lines is still found.
    """
    pattern = rf"(?s)<{re.escape(tag)}>(.*?)</{re.escape(tag)}>"
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def render_template(template: str, null_text: str = "None") -> Column:
    """Compile a ``str.format``-style template (``{col}`` fields) to one ``concat``.

    Every field is cast to text; a NULL renders as ``null_text`` (Python's
    ``format`` prints ``None``), so one NULL does not blank the whole prompt.
    The template is parsed once on the driver; rows are rendered on executors.
    """
    parts: list[Column] = []
    for literal, field, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if spec or conv:
            raise ValueError(f"format specs are not supported in templates: {{{field}}}")
        if not field.isidentifier():
            raise ValueError(f"template fields must be column names: {{{field}}}")
        parts.append(F.coalesce(F.col(f"`{field}`").cast("string"), F.lit(null_text)))
    return F.concat(*parts) if parts else F.lit("")


def template_fields(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


def row_text(cols: Sequence[str]) -> Column:
    """A row rendered as JSON text (NULLs kept), for logging an input record."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
