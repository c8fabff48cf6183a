"""Change-detection hashes.

``row_hash`` is null- and position-aware: the values are rendered to text in a
canonical way and hashed as a JSON array, so ``(a, NULL, b)`` and
``(a, b, NULL)`` differ. ``concat_hash`` is the plain separator-joined form,
which drops NULLs and therefore collides on those rows; it is kept only to
reproduce old hashes.

Canonical text per type: strings as is; integral, boolean and date values by
their SQL text. A floating value that ``decimal(38, scale)`` holds exactly is
printed as that decimal, which does not depend on an engine's float printing; any
other (finer, huge, NaN, infinite) by its shortest round-trip text. So two
different doubles never share a text, and only NULL has none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(df: DataFrame, name: str, double_scale: int = 6) -> Column:
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        exact = c.try_cast(T.DecimalType(38, double_scale))
        return F.when(exact.cast(dtype) == c, exact.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def row_hash(df: DataFrame, cols: Sequence[str], double_scale: int = 6) -> Column:
    """SHA-256 (hex) of the tracked columns; see module docstring."""
    parts = [canonical_text(df, c, double_scale) for c in cols]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def concat_hash(cols: Sequence[str], sep: str = "||") -> Column:
    """Separator-joined SHA-256 (NULLs skipped, so it can collide)."""
    return F.sha2(F.concat_ws(sep, *[F.col(f"`{c}`").cast("string") for c in cols]), 256)
