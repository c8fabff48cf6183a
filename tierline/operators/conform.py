"""Silver conformance: flatten nested text fields, union sources by name, type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.casting import ConformSpec, cast_failures, conform
from tierline.functions.text import json_field, xml_field


def flatten_json(df: DataFrame, source_col: str, fields: Mapping[str, str], drop_source: bool = True) -> DataFrame:
    """Pull ``{target: '$.path'}`` out of a JSON text column (bad JSON → NULL)."""
    out = df.withColumns({t: json_field(source_col, p) for t, p in fields.items()})
    return out.drop(source_col) if drop_source else out


def flatten_xml(df: DataFrame, source_col: str, fields: Mapping[str, str], drop_source: bool = True) -> DataFrame:
    """Pull ``{target: tag}`` out of an XML text column (missing tag → NULL)."""
    out = df.withColumns({t: xml_field(source_col, tag) for t, tag in fields.items()})
    return out.drop(source_col) if drop_source else out


def union_sources(frames: Mapping[str, DataFrame], source_col: str | None = "source") -> DataFrame:
    """Union by column name; a column missing from a source is NULL there.

    Positional union silently shifts values when one source orders its columns
    differently; by-name union cannot.
    """
    out: DataFrame | None = None
    for name, df in frames.items():
        part = df.withColumn(source_col, F.lit(name)) if source_col else df
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("union_sources needs at least one frame")
    return out


def conform_flagged(df: DataFrame, spec: ConformSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns, ``keep``, the names of failed columns (``_tl_failed``), and the raw values where there are any.

    Rows that converted hold NULL for their raw values, so the frame is little larger
    than the typed rows when it is persisted for several consumers.
    """
    raw = list(dict.fromkeys(src for src, _, _ in spec))  # a raw column may feed several targets
    raw_cols = [F.col(f"`{src}`").alias(f"_tl_raw_{src}") for src in raw]
    staged = df.select(*[F.col(f"`{c}`") for c in df.columns], *raw_cols)
    conformed = conform(staged, spec, keep=[*keep, *[f"_tl_raw_{src}" for src in raw]])
    flagged = conformed.withColumn("_tl_failed", cast_failures(spec, raw_prefix="_tl_raw_"))
    failed = F.size("_tl_failed") > 0
    return flagged.withColumns({f"_tl_raw_{src}": F.when(failed, F.col(f"`_tl_raw_{src}`")) for src in raw})


def split_flagged(flagged: DataFrame, spec: ConformSpec, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` of a :func:`conform_flagged` frame; the rejected rows have their raw values and the reason."""
    raw = list(dict.fromkeys(src for src, _, _ in spec))
    out_cols = [dst for _, dst, _ in spec] + list(keep)
    valid = flagged.filter(F.size("_tl_failed") == 0).select(*out_cols)
    rejected = flagged.filter(F.size("_tl_failed") > 0).select(
        *[F.col(f"_tl_raw_{src}").alias(src) for src in raw],
        *keep,
        F.concat(F.lit("Invalid value: "), F.array_join("_tl_failed", ", ")).alias("reject_reason"),
    )
    return valid, rejected


def conform_with_rejects(
    df: DataFrame, spec: ConformSpec, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` after a typed projection.

    A row is rejected when a non-blank raw value did not convert; the reason
    names the columns. Both outputs come from one projection that keeps the raw
    values alongside, so the source is scanned once per consumer.
    """
    return split_flagged(conform_flagged(df, spec, keep), spec, keep)
