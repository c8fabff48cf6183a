"""The composite jobs (bronze → silver → gold) run over the given tables.

Customers arrive from three sources in three formats; every customer with a
non-positive balance is delivered twice (by two sources) and must be
quarantined. A second delivery moves the HOUSEHOLD customers to another
nation, which gives them a new silver row and a new dimension version.
Orders arrive as a fourth source and become facts keyed to the dimension.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import quality
from tierline.plans import jobs
from tierline.plans.catalog import CUSTOMER_ATTRS, CUSTOMER_TEXT_SPEC, table
from tierline.session import scratch_path
from tierline.sources.files import write_source_files
from tierline.sources.tables import DimensionStore, LoadLog

AS_OF = (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))
LAKE_TRACKED = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_SPEC = [
    ("o_orderkey", "o_orderkey", "bigint"),
    ("o_custkey", "c_custkey", "bigint"),
    ("o_totalprice", "o_totalprice", "double"),
    ("o_orderdate", "o_orderdate", "date:dd/MM/yyyy"),
]
SEGMENTS_A = ("AUTOMOBILE", "BUILDING")
SEGMENTS_B = ("FURNITURE", "HOUSEHOLD")


def _text(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


def _nested(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.struct(F.col("c_name").alias("Name")).alias("customer"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
        "c_mktsegment",
    )


def deliver_customers(spark: SparkSession, sf_dir: str, src: str, round_no: int) -> None:
    cust = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    if round_no == 1:
        a = cust.filter(seg.isin(*SEGMENTS_A))
        b = cust.filter(seg.isin(*SEGMENTS_B)).unionByName(cust.filter(F.col("c_acctbal") <= 0))
        c = cust.filter(~F.coalesce(seg.isin(*SEGMENTS_A, *SEGMENTS_B), F.lit(False)))  # everything else
        write_source_files(_text(a, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
                           f"{src}/a", "csv")
        write_source_files(_nested(b), f"{src}/b", "json")
        write_source_files(_nested(c), f"{src}/c", "xml")
    else:
        moved = cust.filter((seg == "HOUSEHOLD") & (F.col("c_acctbal") > 0)).withColumn(
            "c_nationkey", F.col("c_nationkey") + 100
        )
        write_source_files(_nested(moved), f"{src}/b", "json")


def load_customers(spark: SparkSession, lake: jobs.Lake, src: str, round_no: int) -> jobs.SilverResult:
    formats = {"a": ("csv", None), "b": ("json", None), "c": ("xml", {"rowTag": "record"})}
    jobs.bronze_jobs(spark, lake, {f"customer_{name}": (f"{src}/{name}", *how) for name, how in formats.items()})
    sources = {
        "a": jobs.SilverSource(lake.layer("bronze", "customer_a")),
        "b": jobs.SilverSource(lake.layer("bronze", "customer_b"), json_fields={"c_name": ("customer", "$.Name")}),
        "c": jobs.SilverSource(lake.layer("bronze", "customer_c"), xml_fields={"c_name": ("customer", "Name")}),
    }
    return jobs.silver_job(spark, lake, "customer", sources, CUSTOMER_TEXT_SPEC, ["c_custkey", "c_nationkey"],
                           not_null=["c_custkey"], as_of=AS_OF[round_no - 1])


def load_dimension(spark: SparkSession, lake: jobs.Lake, round_no: int) -> None:
    order = [F.col("silver_ingestion_time").desc(), F.col("bronze_ingestion_time").desc(), F.col("file_path").desc()]
    jobs.dimension_job(spark, lake, "dim_customer", "customer", ["c_custkey"], CUSTOMER_ATTRS, LAKE_TRACKED, order,
                       "customer_key", as_of=AS_OF[round_no - 1])


def new_lake(spark: SparkSession, name: str) -> tuple[jobs.Lake, str]:
    """A fresh lake and the folder its sources are delivered to."""
    base = scratch_path(spark, name)
    lake = jobs.Lake(f"{base}/lake")
    lake.create_logs(spark)
    return lake, f"{base}/src"


def build_lake(spark: SparkSession, sf_dir: str, name: str, rounds: int, dimension: bool = True) -> tuple[jobs.Lake, str]:
    lake, src = new_lake(spark, name)
    for r in range(1, rounds + 1):
        deliver_customers(spark, sf_dir, src, r)
        load_customers(spark, lake, src, r)
        if dimension:
            load_dimension(spark, lake, r)
    return lake, src


def load_orders(spark: SparkSession, lake: jobs.Lake, src: str, orders: DataFrame | None, as_of=AS_OF[2]) -> tuple[int, int]:
    """Deliver orders (``None``: nothing new) and load them to silver and to the facts; rows of both."""
    if orders is not None:
        rows = orders.select(
            "o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate")
        )
        write_source_files(_text(rows, rows.columns), f"{src}/orders", "csv")
    jobs.bronze_job(spark, lake, "orders", f"{src}/orders", "csv")
    silver = jobs.silver_job(spark, lake, "orders", {"o": jobs.SilverSource(lake.layer("bronze", "orders"))}, ORDER_SPEC,
                             ["o_orderkey"], not_null=["o_orderkey"], as_of=as_of)
    loaded = jobs.fact_job(spark, lake, "fact_orders", "orders", "dim_customer", ["c_custkey"], "customer_key",
                           ["o_orderkey", "c_custkey", "o_totalprice", "o_orderdate"], as_of=as_of)
    return silver.loaded, loaded


def silver_customers(spark: SparkSession, lake: jobs.Lake) -> DataFrame:
    silver = LoadLog(spark, lake.layer("silver", "customer")).read()
    return silver.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "source")


def fact_orders(spark: SparkSession, lake: jobs.Lake) -> DataFrame:
    return LoadLog(spark, lake.layer("gold", "fact_orders")).read().select(
        "customer_key", "o_orderkey", "c_custkey", "o_totalprice", "o_orderdate", "created_at"
    )


def q_lake_silver(spark, sf_dir):
    lake, _ = build_lake(spark, sf_dir, "lake_silver", rounds=1, dimension=False)
    return silver_customers(spark, lake)


def q_lake_silver_after_idle_run(spark, sf_dir):
    """Load, a run that finds nothing new, a new delivery, load: every row is there."""
    lake, src = build_lake(spark, sf_dir, "lake_silver_idle", rounds=1, dimension=False)
    load_customers(spark, lake, src, 1)
    deliver_customers(spark, sf_dir, src, 2)
    load_customers(spark, lake, src, 2)
    return silver_customers(spark, lake)


def q_lake_quarantine(spark, sf_dir):
    lake, _ = build_lake(spark, sf_dir, "lake_quarantine", rounds=1, dimension=False)
    rejects = jobs.read_rejects(spark, lake, "customer")
    return rejects.select(
        F.get_json_object("payload", "$.c_custkey").cast("bigint").alias("c_custkey"),
        F.get_json_object("payload", "$.source").alias("source"),
        "reject_reason",
    )


def q_lake_dimension(spark, sf_dir):
    lake, _ = build_lake(spark, sf_dir, "lake_dimension", rounds=2)
    dim = DimensionStore(spark, lake.layer("gold", "dim_customer")).read()
    return dim.select("c_custkey", "c_nationkey", "c_acctbal", "customer_key", "is_current", "start_date", "end_date")


def q_lake_fact(spark, sf_dir):
    lake, src = build_lake(spark, sf_dir, "lake_fact", rounds=2)
    load_orders(spark, lake, src, table(spark, sf_dir, "orders"))
    return fact_orders(spark, lake)


def _two_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    done = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    return orders.filter(done), orders.filter(~done)


def q_lake_fact_after_idle_run(spark, sf_dir):
    """Facts of a first delivery, a run that finds nothing new, facts of the second."""
    lake, src = build_lake(spark, sf_dir, "lake_fact_idle", rounds=1)
    first, second = _two_deliveries(spark, sf_dir)
    load_orders(spark, lake, src, first)
    idle = load_orders(spark, lake, src, None)
    load_orders(spark, lake, src, second)
    return fact_orders(spark, lake).withColumn("idle_rows", F.lit(sum(idle)).cast("long"))


def q_lake_fact_same_as_of(spark, sf_dir):
    """A second silver load with an earlier time than the first: gold goes by load, not by time."""
    lake, src = build_lake(spark, sf_dir, "lake_fact_as_of", rounds=1)
    first, second = _two_deliveries(spark, sf_dir)
    load_orders(spark, lake, src, first, as_of=AS_OF[2])
    load_orders(spark, lake, src, second, as_of=AS_OF[1])
    return fact_orders(spark, lake).drop("created_at")


def q_quality_results_log(spark, sf_dir):
    """The result log after a load that passes its gates and one that a NULL gate stops."""
    lake, src = build_lake(spark, sf_dir, "quality_log", rounds=1, dimension=False)
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    write_source_files(_text(orders.withColumn("o_totalprice", price), orders.columns), f"{src}/gated", "csv")
    jobs.bronze_job(spark, lake, "gated", f"{src}/gated", "csv")
    with contextlib.suppress(quality.QualityError):
        jobs.silver_job(spark, lake, "gated", {"o": jobs.SilverSource(lake.layer("bronze", "gated"))},
                        [("o_orderkey", "o_orderkey", "bigint"), ("o_totalprice", "o_totalprice", "double")],
                        ["o_orderkey"], as_of=AS_OF[0], required=["o_orderkey", "o_totalprice"], null_gates=["o_totalprice"])
    return jobs.quality_log(spark, lake).select("layer", "table_name", "check_name", "status", "failed_records", "message", "created_time")


LAKE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lake_silver": q_lake_silver,
    "lake_quarantine": q_lake_quarantine,
    "lake_dimension": q_lake_dimension,
    "lake_fact": q_lake_fact,
    "lake_silver_after_idle_run": q_lake_silver_after_idle_run,
    "lake_fact_after_idle_run": q_lake_fact_after_idle_run,
    "lake_fact_same_as_of": q_lake_fact_same_as_of,
    "quality_results_log": q_quality_results_log,
}

_SOURCE = "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'a' " \
          "WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'b' ELSE 'c' END"
_DIM = """
  d1 AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment,
                row_number() OVER (ORDER BY c_custkey) AS customer_key
         FROM customer WHERE c_acctbal > 0),
  moved AS (SELECT c_custkey, c_nationkey + 100 AS c_nationkey, c_acctbal,
                   (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY c_custkey) AS customer_key
            FROM d1 WHERE c_mktsegment = 'HOUSEHOLD'),
  dim AS (
    SELECT c_custkey, c_nationkey, c_acctbal, customer_key, c_mktsegment <> 'HOUSEHOLD' AS is_current,
           DATE '2024-01-01' AS start_date,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN DATE '2024-02-01' END AS end_date
    FROM d1
    UNION ALL
    SELECT c_custkey, c_nationkey, c_acctbal, customer_key, TRUE, DATE '2024-02-01', CAST(NULL AS DATE) FROM moved)"""

LAKE_ORACLE: dict[str, str] = {
    "lake_silver": f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, {_SOURCE} AS source
        FROM customer WHERE c_acctbal > 0""",
    "lake_quarantine": f"""
        SELECT c_custkey, {_SOURCE} AS source, 'Duplicate business key' AS reject_reason
        FROM customer WHERE c_acctbal <= 0
        UNION ALL
        SELECT c_custkey, 'b', 'Duplicate business key' FROM customer WHERE c_acctbal <= 0""",
    "lake_dimension": f"WITH {_DIM} SELECT * FROM dim",
    "lake_fact": f"""
        WITH {_DIM}
        SELECT d.customer_key, o.o_orderkey, o.o_custkey AS c_custkey, o.o_totalprice,
               CAST(o.o_orderdate AS DATE) AS o_orderdate, TIMESTAMP '2024-03-01 00:00:00' AS created_at
        FROM orders o LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON o.o_custkey = d.c_custkey""",
    "lake_silver_after_idle_run": f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, {_SOURCE} AS source
        FROM customer WHERE c_acctbal > 0
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey + 100, c_acctbal, c_mktsegment, 'b'
        FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'HOUSEHOLD'""",
    "lake_fact_after_idle_run": f"""
        WITH {_DIM}
        SELECT d1.customer_key, o.o_orderkey, o.o_custkey AS c_custkey, o.o_totalprice,
               CAST(o.o_orderdate AS DATE) AS o_orderdate, TIMESTAMP '2024-03-01 00:00:00' AS created_at,
               CAST(0 AS BIGINT) AS idle_rows
        FROM orders o LEFT JOIN d1 ON o.o_custkey = d1.c_custkey""",
    "lake_fact_same_as_of": f"""
        WITH {_DIM}
        SELECT d1.customer_key, o.o_orderkey, o.o_custkey AS c_custkey, o.o_totalprice,
               CAST(o.o_orderdate AS DATE) AS o_orderdate
        FROM orders o LEFT JOIN d1 ON o.o_custkey = d1.c_custkey""",
    "quality_results_log": """
        WITH twice AS (SELECT count(*) * 2 AS n FROM customer WHERE c_acctbal <= 0),
        missing AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW'),
        r(table_name, check_name, status, failed_records, message) AS (
          SELECT t, 'schema_check', 'PASS', 0, NULL
          FROM (VALUES ('customer.a'), ('customer.b'), ('customer.c'), ('customer'), ('gated.o'), ('gated')) AS v(t)
          UNION ALL SELECT 'customer', 'business_key_check', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n,
                           n || ' rows quarantined' FROM twice
          UNION ALL SELECT 'customer', c, 'PASS', 0, '0 rows quarantined'
          FROM (VALUES ('cast_check'), ('key_null_check'), ('record_check')) AS v(c)
          UNION ALL SELECT 'gated', 'o_totalprice_null_check', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n,
                           n || ' NULL values' FROM missing)
        SELECT 'silver' AS layer, table_name, check_name, status, CAST(failed_records AS BIGINT) AS failed_records,
               message, TIMESTAMP '2024-01-01 00:00:00' AS created_time
        FROM r""",
}
