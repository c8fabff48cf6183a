"""Driver-contract queries over the generated tables.

Each query rebuilds one behaviour of the layered jobs on the TPC-H-like tables
(customers as a dimension, orders as facts, events as an ingested stream, ...)
and runs over the whole tables. Edits that a scenario needs (a second batch
with changed, new and absent keys; damaged text; derived NULLs) are
deterministic functions of the rows, written the same way in the SQL oracle
(``tierline.plans.oracle``).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.casting import conform
from tierline.functions.hashing import row_hash
from tierline.functions.text import render_template
from tierline.operators import conform as conform_ops
from tierline.operators import dedup, enrich, facts, incremental, keys, metadata, quality, runlog, scd2

# Fixed scenario parameters (shared with the oracle SQL).
AS_OF_1 = "2024-01-01 00:00:00"
AS_OF_2 = "2024-02-01 00:00:00"
MARK_LO = "2024-01-10 00:00:00"
MARK_HI = "2024-01-25 00:00:00"
NEW_KEY_OFFSET = 1_000_000
REVIEW_PRICE = 400000
ORDER_PROMPT = (
    "Order {o_orderkey} of customer {o_custkey} costs {o_totalprice}, has status {o_orderstatus} and priority "
    "{o_orderpriority}.\nIs its price plausible? Answer yes or no with one reason."
)
DOC_PROMPT = "Summarize the following {lang} text from {source}:\n{text}"

CUSTOMER_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_TRACKED = ["c_name", "c_acctbal", "c_mktsegment"]

ORDER_TEXT_SPEC = [
    ("Order_Key", "o_orderkey", "bigint"),
    ("Customer_Key", "o_custkey", "bigint"),
    ("Order_Date", "o_orderdate", "date:dd/MM/yyyy"),
    ("Total_Price", "o_totalprice", "double"),
    ("Status", "o_orderstatus", "string"),
    ("Priority", "o_orderpriority", "string"),
]

TABLE_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
TABLE_REQUIRED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
# The schema check of one table names a column it does not have, to show FAIL.
SCHEMA_CHECKS = {
    "customer": ["c_custkey", "c_name", "c_acctbal"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_comment"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_quantity"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- conform


def orders_as_text(orders: DataFrame) -> DataFrame:
    """Orders as a text source delivers them (all strings, dates dd/MM/yyyy)."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("Order_Key"),
        F.col("o_custkey").cast("string").alias("Customer_Key"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Order_Date"),
        F.col("o_totalprice").cast("string").alias("Total_Price"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("Priority"),
    )


def q_conform_orders(spark, sf_dir):
    return conform(orders_as_text(table(spark, sf_dir, "orders")), ORDER_TEXT_SPEC)


def damaged_orders_text(orders: DataFrame) -> DataFrame:
    text = orders_as_text(orders)
    return text.withColumn(
        "Order_Date", F.when(F.col("Priority") == "5-LOW", F.lit("n/a")).otherwise(F.col("Order_Date"))
    ).withColumn(
        "Total_Price",
        F.when(F.col("Priority") == "4-NOT SPECIFIED", F.concat("Total_Price", F.lit(" USD"))).otherwise(
            F.col("Total_Price")
        ),
    )


def q_rejects_bad_casts(spark, sf_dir):
    _, rejected = conform_ops.conform_with_rejects(damaged_orders_text(table(spark, sf_dir, "orders")), ORDER_TEXT_SPEC)
    return rejected.select("Order_Key", "Order_Date", "reject_reason")


def q_conform_valid(spark, sf_dir):
    valid, _ = conform_ops.conform_with_rejects(damaged_orders_text(table(spark, sf_dir, "orders")), ORDER_TEXT_SPEC)
    return valid


def q_flatten_json(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return conform_ops.flatten_json(
        events.select("event_id", "user_id", "event_type", "props"), "props", {"k": "$.k"}
    )


def customer_xml(cust: DataFrame) -> DataFrame:
    """Customer rows as XML text; customers with a non-positive balance lack the segment tag."""
    seg = F.when(
        F.col("c_acctbal") > 0, F.concat(F.lit("<Segment>"), F.col("c_mktsegment"), F.lit("</Segment>"))
    ).otherwise(F.lit(""))
    xml = F.concat(F.lit("<customer>\n<Name>"), F.col("c_name"), F.lit("</Name>\n"), seg, F.lit("\n</customer>"))
    return cust.select("c_custkey", xml.alias("customer"))


def q_flatten_xml(spark, sf_dir):
    xml = customer_xml(table(spark, sf_dir, "customer"))
    return conform_ops.flatten_xml(xml, "customer", {"c_name": "Name", "c_mktsegment": "Segment"})


def customer_sources(cust: DataFrame) -> dict[str, DataFrame]:
    """Customers delivered by three sources of different shapes (by segment)."""
    as_text = {c: F.col(c).cast("string") for c in ["c_custkey", "c_nationkey", "c_acctbal"]}
    a = cust.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).select(
        "c_mktsegment", as_text["c_custkey"].alias("c_custkey"), "c_name", as_text["c_acctbal"].alias("c_acctbal"),
        as_text["c_nationkey"].alias("c_nationkey"),
    )
    b = cust.filter(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")).select(
        as_text["c_custkey"].alias("c_custkey"),
        F.to_json(F.struct(F.col("c_name").alias("Name"))).alias("customer"),
        as_text["c_nationkey"].alias("c_nationkey"), as_text["c_acctbal"].alias("c_acctbal"), "c_mktsegment",
    )
    taken = F.coalesce(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"), F.lit(False))
    c = cust.filter(~taken).select(
        as_text["c_custkey"].alias("c_custkey"),
        F.concat(F.lit("<customer><Name>"), F.col("c_name"), F.lit("</Name></customer>")).alias("customer"),
        as_text["c_nationkey"].alias("c_nationkey"), as_text["c_acctbal"].alias("c_acctbal"), "c_mktsegment",
    )
    return {"a": a, "b": b, "c": c}


CUSTOMER_TEXT_SPEC = [
    ("c_custkey", "c_custkey", "bigint"),
    ("c_name", "c_name", "string"),
    ("c_nationkey", "c_nationkey", "int"),
    ("c_acctbal", "c_acctbal", "double"),
    ("c_mktsegment", "c_mktsegment", "string"),
]


def q_union_three_sources(spark, sf_dir):
    src = customer_sources(table(spark, sf_dir, "customer"))
    b = conform_ops.flatten_json(src["b"], "customer", {"c_name": "$.Name"})
    c = conform_ops.flatten_xml(src["c"], "customer", {"c_name": "Name"})
    union = conform_ops.union_sources({"a": src["a"], "b": b, "c": c}, "source")
    return conform(union, CUSTOMER_TEXT_SPEC, keep=["source"])


# ---------------------------------------------------------------- incremental


def q_incremental_filter(spark, sf_dir):
    events = incremental.bounded(table(spark, sf_dir, "events"), "ts", F.lit(MARK_LO).cast("timestamp_ntz"),
                                 F.lit(MARK_HI).cast("timestamp_ntz"))
    return incremental.new_marks(events, "ts", by=["event_type"])


def q_incremental_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return incremental.bounded(
        events, "ts", F.lit(MARK_LO).cast("timestamp_ntz"), F.lit(MARK_HI).cast("timestamp_ntz")
    ).select("event_id", "user_id", "event_type", "ts")


def mark_log(events: DataFrame) -> DataFrame:
    """Events read as mark updates: one pipeline per event type, one destination per user."""
    return events.select(
        F.col("event_type").alias("pipeline_name"),
        F.lit("events").alias("pipeline_src"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("pipeline_destination"),
        # date_trunc returns a zoned timestamp; cast back so the mark stays zone-free like ts.
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("ingestion_time"),
        F.col("ts").alias("updated_at"),
    )


def q_latest_mark(spark, sf_dir):
    return incremental.latest_marks(mark_log(table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- dedup


def q_anti_join_new(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    loaded = orders.filter(F.col("o_orderstatus") == "F")
    return dedup.anti_join_new(orders, loaded, ["o_orderkey", "o_custkey"], null_safe=False)


def orders_with_close(orders: DataFrame) -> DataFrame:
    close = F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.to_date("o_orderdate"))
    return orders.select("o_orderkey", "o_orderpriority", close.alias("close_date"))


def q_anti_join_null_keys(spark, sf_dir):
    orders = orders_with_close(table(spark, sf_dir, "orders"))
    loaded = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return dedup.anti_join_new(orders, loaded, ["o_orderkey", "close_date"], null_safe=True).select(
        "o_orderkey", "close_date"
    )


def q_latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return dedup.latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


# ---------------------------------------------------------------- quality


def customer_with_nulls(cust: DataFrame) -> DataFrame:
    return cust.select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"), "c_nationkey"
    )


def q_null_report(spark, sf_dir):
    return quality.null_report(customer_with_nulls(table(spark, sf_dir, "customer")), ["c_custkey", "c_name", "c_acctbal"])


def q_positive_report(spark, sf_dir):
    return quality.positive_report(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


def q_required_columns(spark, sf_dir):
    parts = []
    for name, required in SCHEMA_CHECKS.items():
        df = table(spark, sf_dir, name)
        r = quality.check_columns(df, "silver", name, required)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("total_records")).select(
                F.lit(r.table_name).alias("table_name"),
                F.lit(r.check_name).alias("check_name"),
                F.lit(r.status).alias("status"),
                F.lit(r.failed_records).cast("long").alias("failed_records"),
                F.lit(r.message).cast("string").alias("message"),
                "total_records",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orders_business_key(orders: DataFrame) -> DataFrame:
    day = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise(F.to_date("o_orderdate"))
    return orders.select("o_orderkey", "o_custkey", day.alias("order_day"))


def q_dup_key_valid(spark, sf_dir):
    valid, _ = quality.split_duplicate_keys(orders_business_key(table(spark, sf_dir, "orders")), ["o_custkey", "order_day"])
    return valid


def q_dup_key_rejected(spark, sf_dir):
    _, rejected = quality.split_duplicate_keys(
        orders_business_key(table(spark, sf_dir, "orders")), ["o_custkey", "order_day"]
    )
    return rejected


def q_dup_groups(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_name")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def q_expectations_report(spark, sf_dir):
    return quality.expectations_report(
        {name: (table(spark, sf_dir, name), TABLE_REQUIRED[name], TABLE_KEYS[name]) for name in TABLE_KEYS}
    )


# ---------------------------------------------------------------- keys, hashes, SCD2, facts


def part_with_nulls(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey", "p_name", F.when(F.col("p_size") >= 10, F.col("p_brand")).alias("p_brand"), "p_type", "p_size",
        "p_retailprice",
    )


HASHED_PART = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def q_row_hash(spark, sf_dir):
    part = part_with_nulls(table(spark, sf_dir, "part"))
    return part.select("p_partkey", row_hash(part, HASHED_PART).alias("hash_value"))


def q_row_hash_doubles(spark, sf_dir):
    """Whether the change hash tells a double from a close, a huge, a NaN and a NULL one."""
    balance = F.col("c_acctbal")
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", (balance * 1e-9).alias("tiny"), (balance * 1e-9 * (1 + 2.0**-50)).alias("next"),
        (balance * 1e35).alias("huge"), F.lit(float("nan")).alias("nan"), F.lit(None).cast("double").alias("none"),
        (balance + 0.0).alias("same"), balance.alias("balance"),
    )
    pairs = [("tiny", "next"), ("tiny", "huge"), ("nan", "none"), ("nan", "balance"), ("same", "balance")]
    return cust.select(
        "c_custkey", *[(row_hash(cust, [a]) != row_hash(cust, [b])).alias(f"{a}_{b}") for a, b in pairs]
    )


def q_scd2_null_key(spark, sf_dir):
    """Customers of nation 0 share a NULL key: two equal loads leave one current row for it."""
    cust = table(spark, sf_dir, "customer")
    batch = cust.withColumn("c_custkey", F.when(F.col("c_nationkey") != 0, F.col("c_custkey")))
    load = functools.partial(
        scd2.scd2_apply, incoming=batch, keys=["c_custkey"], attrs=CUSTOMER_ATTRS, tracked=CUSTOMER_TRACKED,
        order=[F.col("c_name").desc()], key_col="customer_key",
    )
    first = load(None, as_of=F.lit(AS_OF_1).cast("timestamp_ntz")).state
    second = load(first, as_of=F.lit(AS_OF_2).cast("timestamp_ntz")).state
    return second.select("c_custkey", "c_name", "c_acctbal", "is_current", "start_date", "end_date")


def q_surrogate_keys(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return keys.assign_keys(cust, ["c_nationkey", "c_custkey"], "customer_key")


def customer_dimension(spark, sf_dir) -> scd2.Scd2Result:
    cust = table(spark, sf_dir, "customer")
    return scd2.scd2_apply(
        None, cust, ["c_custkey"], CUSTOMER_ATTRS, CUSTOMER_TRACKED, [F.col("c_custkey")],
        F.lit(AS_OF_1).cast("timestamp_ntz"), "customer_key",
    )


def customer_second_batch(cust: DataFrame) -> DataFrame:
    """Second delivery: nation 0 absent, MACHINERY balances +100, HOUSEHOLD nation moved
    (untracked), FURNITURE delivered twice (the later copy +1), BUILDING re-issued under new keys."""
    seg = F.col("c_mktsegment")
    base = (
        cust.filter(F.col("c_nationkey") != 0)
        .withColumn("c_acctbal", F.when(seg == "MACHINERY", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
        .withColumn("c_nationkey", F.when(seg == "HOUSEHOLD", F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")))
        .withColumn("seq", F.lit(1))
    )
    again = base.filter(seg == "FURNITURE").withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("seq", F.lit(2))
    reissued = cust.filter(seg == "BUILDING").withColumn("c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET).withColumn(
        "seq", F.lit(1)
    )
    return base.unionByName(again).unionByName(reissued)


def customer_second_load(spark, sf_dir) -> scd2.Scd2Result:
    first = customer_dimension(spark, sf_dir).state
    batch = customer_second_batch(table(spark, sf_dir, "customer"))
    return scd2.scd2_apply(
        first, batch, ["c_custkey"], CUSTOMER_ATTRS, CUSTOMER_TRACKED, [F.col("seq").desc()],
        F.lit(AS_OF_2).cast("timestamp_ntz"), "customer_key",
    )


def q_scd2_first_load(spark, sf_dir):
    return customer_dimension(spark, sf_dir).state


def q_scd2_changes(spark, sf_dir):
    return customer_second_load(spark, sf_dir).changes


def q_scd2_second_load(spark, sf_dir):
    return customer_second_load(spark, sf_dir).state


def q_scd2_current(spark, sf_dir):
    return customer_second_load(spark, sf_dir).state.filter(F.col("is_current"))


FACT_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]


def q_fact_load(spark, sf_dir):
    dim = customer_dimension(spark, sf_dir).state
    orders = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey"))
    return facts.fact_rows(orders, dim, ["c_custkey"], "customer_key", FACT_COLUMNS,
                           created_at=F.lit(AS_OF_1).cast("timestamp_ntz"), prefilter=False)


def q_fact_missing_dim(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") != 0)
    dim = scd2.scd2_apply(
        None, cust, ["c_custkey"], CUSTOMER_ATTRS, CUSTOMER_TRACKED, [F.col("c_custkey")],
        F.lit(AS_OF_1).cast("timestamp_ntz"), "customer_key",
    ).state
    orders = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey"))
    return facts.fact_rows(orders, dim, ["c_custkey"], "customer_key", FACT_COLUMNS,
                           created_at=F.lit(AS_OF_1).cast("timestamp_ntz"))


def q_fact_point_in_time(spark, sf_dir):
    """Facts keyed to the dimension version valid on the fact's date (after load 2)."""
    dim = customer_second_load(spark, sf_dir).state
    orders = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey")).withColumn(
        "fact_date", F.when(F.col("o_orderstatus") == "O", F.lit(AS_OF_2)).otherwise(F.lit(AS_OF_1)).cast("date")
    )
    return facts.fact_rows(orders, dim, ["c_custkey"], "customer_key", ["o_orderkey", "o_custkey", "fact_date"],
                           created_at=F.lit(AS_OF_2).cast("timestamp_ntz"), point_in_time_col="fact_date",
                           prefilter=False)


# ---------------------------------------------------------------- metadata-driven


CLEAN_RULES = [
    {"column": "p_name", "action": "trim"},
    {"column": "p_name", "action": "lower"},
    {"column": "p_type", "action": "trim"},
    {"column": "p_type", "action": "lower"},
    {"column": "p_retailprice", "action": "cast_double"},
    {"column": "p_retailprice", "action": "band", "target": "price_band"},
]

GOLD_CONFIG = {
    "aggregation": {"group_by": ["o_custkey", "c_name"]},
    "metrics": [
        {"column": "o_totalprice", "function": "sum", "alias": "price_sum", "round": 2},
        {"column": "*", "function": "count", "alias": "n_orders"},
        {"column": "o_totalprice", "function": "max", "alias": "price_max"},
    ],
}


def product_catalog(part: DataFrame) -> DataFrame:
    """Parts as a raw product catalog: padded, upper-cased names, text prices."""
    return part.select(
        "p_partkey",
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("p_name"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("p_type"),
        F.concat(F.lit(" "), F.col("p_retailprice").cast("string")).alias("p_retailprice"),
    )


def q_clean_rules(spark, sf_dir):
    return metadata.apply_rules(product_catalog(table(spark, sf_dir, "part")), CLEAN_RULES)


def orders_clean(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_custkey", "c_name", "o_totalprice")


def q_gold_metrics(spark, sf_dir):
    return metadata.aggregate_metrics(orders_clean(spark, sf_dir), GOLD_CONFIG)


# ---------------------------------------------------------------- enrichment


def q_threshold_prompts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > REVIEW_PRICE)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return orders.select(*cols).select("o_orderkey", render_template(ORDER_PROMPT).alias("prompt"))


def q_enrich_deterministic(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", render_template(DOC_PROMPT).alias("prompt"))
    return enrich.enrich_with_model(docs, "prompt", enrich.digest_scorer).select("doc_id", "ai_result")


# ---------------------------------------------------------------- run, audit, metric logs


def order_runs(orders: DataFrame) -> DataFrame:
    """Orders read as job runs: F finished, P failed, O still running."""
    return orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("layer"),
        F.concat(F.lit("order_"), F.col("o_custkey").cast("string")).alias("job_name"),
        F.col("o_orderstatus"),
        F.col("o_orderdate").alias("start_time"),
        F.floor("o_totalprice").alias("amount"),
    )


def q_update_by_key(spark, sf_dir):
    runs = order_runs(table(spark, sf_dir, "orders"))
    target = runs.select(
        "run_id", "layer", "job_name", F.lit("RUNNING").alias("status"), "start_time",
        F.lit(None).cast("timestamp_ntz").alias("end_time"), F.lit(0).cast("long").alias("records"),
        F.lit(None).cast("string").alias("error"),
    )
    updates = runs.filter(F.col("o_orderstatus").isin("F", "P")).select(
        "run_id",
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        (F.col("start_time") + F.expr("INTERVAL 1 DAY")).alias("end_time"),
        F.col("amount").cast("long").alias("records"),
        F.when(F.col("o_orderstatus") == "P", F.lit("partial shipment")).alias("error"),
    )
    return runlog.update_by_key(target, updates, ["run_id"], ["status", "end_time", "records", "error"])


def run_log(orders: DataFrame) -> DataFrame:
    runs = order_runs(orders)
    starts = runs.select(
        "run_id", "layer", "job_name", F.lit("RUNNING").alias("status"), F.col("start_time").alias("event_time"),
        F.lit(0).cast("long").alias("records"), F.lit(None).cast("string").alias("error"),
    )
    # A failed run logs its end at the same instant as its start (tie on time).
    ends = runs.filter(F.col("o_orderstatus").isin("F", "P")).select(
        "run_id", F.lit(None).cast("string").alias("layer"), F.lit(None).cast("string").alias("job_name"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("start_time") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("start_time")).alias("event_time"),
        F.col("amount").cast("long").alias("records"),
        F.when(F.col("o_orderstatus") == "P", F.lit("partial shipment")).alias("error"),
    )
    return starts.unionByName(ends)


def q_run_log_latest(spark, sf_dir):
    return runlog.latest_state(run_log(table(spark, sf_dir, "orders")))


def q_audit_events(spark, sf_dir):
    state = runlog.latest_state(run_log(table(spark, sf_dir, "orders")))
    return runlog.audit_events(state).drop("audit_id", "timestamp")


METRIC_TABLES = ["customer", "orders", "lineitem", "part", "supplier"]


def q_job_metrics(spark, sf_dir):
    counts = {name: table(spark, sf_dir, name) for name in METRIC_TABLES}
    return runlog.job_metrics({f"bronze_{n}": df for n, df in counts.items()}, run_time=F.lit(AS_OF_1)).drop(
        "run_time"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_orders": q_conform_orders,
    "conform_valid": q_conform_valid,
    "rejects_bad_casts": q_rejects_bad_casts,
    "flatten_json": q_flatten_json,
    "flatten_xml": q_flatten_xml,
    "union_three_sources": q_union_three_sources,
    "incremental_filter": q_incremental_filter,
    "incremental_rows": q_incremental_rows,
    "latest_mark": q_latest_mark,
    "anti_join_new": q_anti_join_new,
    "anti_join_null_keys": q_anti_join_null_keys,
    "latest_per_key": q_latest_per_key,
    "null_report": q_null_report,
    "positive_report": q_positive_report,
    "required_columns": q_required_columns,
    "dup_key_valid": q_dup_key_valid,
    "dup_key_rejected": q_dup_key_rejected,
    "dup_groups": q_dup_groups,
    "expectations_report": q_expectations_report,
    "row_hash": q_row_hash,
    "row_hash_doubles": q_row_hash_doubles,
    "surrogate_keys": q_surrogate_keys,
    "scd2_null_key": q_scd2_null_key,
    "scd2_first_load": q_scd2_first_load,
    "scd2_changes": q_scd2_changes,
    "scd2_second_load": q_scd2_second_load,
    "scd2_current": q_scd2_current,
    "fact_load": q_fact_load,
    "fact_missing_dim": q_fact_missing_dim,
    "fact_point_in_time": q_fact_point_in_time,
    "clean_rules": q_clean_rules,
    "gold_metrics": q_gold_metrics,
    "threshold_prompts": q_threshold_prompts,
    "enrich_deterministic": q_enrich_deterministic,
    "update_by_key": q_update_by_key,
    "run_log_latest": q_run_log_latest,
    "audit_events": q_audit_events,
    "job_metrics": q_job_metrics,
}
