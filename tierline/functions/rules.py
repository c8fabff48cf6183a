"""Configuration-driven column rules and aggregate metrics.

Configs are plain dicts (a YAML reader is the caller's business). Rules map to
built-in column expressions only, so a whole rule list compiles into a single
projection inside one codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default price bands of the catalog rule (lower bound, label),
# checked from the highest bound down, with the last label for everything below.
DEFAULT_BANDS: Sequence[tuple[float, str]] = ((1000, "Premium"), (500, "Standard"))
DEFAULT_BAND_ELSE = "Budget"


def _trim(c: Column, rule: Mapping) -> Column:
    return F.trim(c)


def _upper(c: Column, rule: Mapping) -> Column:
    return F.upper(c)


def _lower(c: Column, rule: Mapping) -> Column:
    return F.lower(c)


def _cast_double(c: Column, rule: Mapping) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


RULE_ACTIONS: dict[str, Callable[[Column, Mapping], Column]] = {
    "trim": _trim,
    "upper": _upper,
    "lower": _lower,
    "cast_double": _cast_double,
}


def band(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """``when(c >= b1, l1).when(c >= b2, l2)…otherwise(x)``; bounds are sorted high → low."""
    ordered = sorted(bands, key=lambda b: b[0], reverse=True)
    expr = None
    for bound, label in ordered:
        cond = c >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


# Aggregate functions a metrics config may name (allow-list; no eval of names).
METRIC_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
}


def metric_column(spec: Mapping) -> Column:
    fn_name = spec["function"]
    if fn_name not in METRIC_FUNCTIONS:
        raise ValueError(f"unknown metric function {fn_name!r}; allowed: {sorted(METRIC_FUNCTIONS)}")
    source = spec.get("column", "*")
    arg = F.lit(1) if source == "*" else F.col(f"`{source}`")
    out = METRIC_FUNCTIONS[fn_name](arg)
    if spec.get("round") is not None:
        out = F.round(out, int(spec["round"]))
    alias = spec.get("alias") or f"{fn_name}_{source}"
    return out.alias(alias)
