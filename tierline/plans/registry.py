"""All registered queries and their oracles, in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tierline.plans.catalog import QUERIES

    out = dict(QUERIES)
    from tierline.plans.streams import STREAM_QUERIES

    out.update(STREAM_QUERIES)
    from tierline.plans.lake import LAKE_QUERIES

    out.update(LAKE_QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from tierline.plans.oracle import ORACLE

    out = dict(ORACLE)
    from tierline.plans.streams import STREAM_ORACLE

    out.update(STREAM_ORACLE)
    from tierline.plans.lake import LAKE_ORACLE

    out.update(LAKE_ORACLE)
    return out
