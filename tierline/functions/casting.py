"""Typed conformance of raw text columns.

A conform spec is an ordered list of ``(source, target, type)``. ``type`` is a
Spark SQL type name, or ``date:<pattern>`` / ``timestamp:<pattern>`` for text
dates. Every cast is a *try* cast: a value that cannot be converted becomes
NULL instead of failing the job (Spark runs with ANSI mode on), and
``cast_failures`` names the columns where that happened so the row can be
routed to quarantine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ConformSpec = Sequence[tuple[str, str, str]]


def parse_date(c: Column | str, pattern: str) -> Column:
    """Text → date with an explicit pattern; bad or empty text → NULL."""
    return F.try_to_date(_col(c), pattern)


def parse_timestamp(c: Column | str, pattern: str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def typed(c: Column | str, type_spec: str) -> Column:
    """One conformed value for a spec type (see module docstring)."""
    kind, _, pattern = type_spec.partition(":")
    column = _col(c)
    if pattern and kind == "date":
        return parse_date(column, pattern)
    if pattern and kind == "timestamp":
        return parse_timestamp(column, pattern)
    if kind in ("double", "float", "int", "bigint", "smallint", "decimal") or kind.startswith(
        "decimal("
    ):
        # Padded numbers ("  12 ") are common in text sources.
        column = F.trim(column.cast("string"))
    return column.try_cast(kind)


def conform(df: DataFrame, spec: ConformSpec, keep: Iterable[str] = ()) -> DataFrame:
    """Rename-and-cast projection (one ``select``; Catalyst folds it into the scan)."""
    cols = [typed(src, t).alias(dst) for src, dst, t in spec]
    cols += [F.col(k) for k in keep]
    return df.select(*cols)


def cast_failures(spec: ConformSpec, raw_prefix: str = "") -> Column:
    """Array of target names whose raw value was non-blank but did not convert.

    Evaluate on a frame that still carries the raw columns (named
    ``raw_prefix + source``) next to the conformed ones.
    """
    checks, some = [], F.lit(False)
    for src, dst, _ in spec:
        raw = F.col(f"`{raw_prefix}{src}`")
        failed = (
            raw.isNotNull() & (F.trim(raw.cast("string")) != F.lit("")) & F.col(f"`{dst}`").isNull()
        )
        checks.append(F.when(failed, F.lit(dst)))
        some = some | failed
    # the names are put together for failed rows only: most rows have none
    return F.when(some, F.filter(F.array(*checks), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value) -> Column:
    """A zone-free timestamp from a Column, an ISO string or a datetime.

    A Python ``datetime`` goes through its ISO text, so the value does not
    depend on the Python process's or the session's time zone.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def literal_like(value, dtype: T.DataType) -> Column:
    """``value`` as a literal of a column's type (zone-free columns get zone-free literals)."""
    if isinstance(value, Column):
        return value
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_literal(value)
    return F.lit(value)
