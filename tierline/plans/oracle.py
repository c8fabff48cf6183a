"""DuckDB SQL oracles for the catalog queries (same column names and types).

These are written directly against the tables, in the textbook SQL form
(windows, ``NOT EXISTS``, ``row_number() OVER (ORDER BY …)``) rather than the
strategies the Spark side uses, so the two are independent.
"""

from __future__ import annotations

from tierline.plans.catalog import (
    AS_OF_1,
    AS_OF_2,
    MARK_HI,
    MARK_LO,
    METRIC_TABLES,
    NEW_KEY_OFFSET,
    REVIEW_PRICE,
    SCHEMA_CHECKS,
    TABLE_KEYS,
    TABLE_REQUIRED,
)

NL = "chr(10)"


def _dec(c: str) -> str:
    """Text of a double: as a decimal where that is exact, else its shortest round-trip form."""
    decimal = f"CAST({c} AS DECIMAL(38,6))"
    return f"CASE WHEN CAST({decimal} AS DOUBLE) = {c} THEN CAST({decimal} AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


CUSTOMER_HASH = f"sha256(to_json([c_name, {_dec('c_acctbal')}, c_mktsegment]))"

# Customer dimension after the first load.
DIM1 = f"""
dim1 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         {CUSTOMER_HASH} AS hash_value,
         row_number() OVER (ORDER BY c_custkey) AS customer_key,
         CAST(DATE '{AS_OF_1[:10]}' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date,
         TRUE AS is_current, TIMESTAMP '{AS_OF_1}' AS created_at, TIMESTAMP '{AS_OF_1}' AS updated_at
  FROM customer)"""

# Second batch, its latest row per key, and the change set with new keys.
CHANGES = f"""
b AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment, 1 AS seq
  FROM customer WHERE c_nationkey <> 0),
batch AS (
  SELECT * FROM b
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment, 2 FROM b WHERE c_mktsegment = 'FURNITURE'
  UNION ALL SELECT c_custkey + {NEW_KEY_OFFSET}, c_name, c_nationkey, c_acctbal, c_mktsegment, 1
            FROM customer WHERE c_mktsegment = 'BUILDING'),
latest AS (
  SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1),
staged AS (SELECT *, {CUSTOMER_HASH} AS hash_value FROM latest),
ch0 AS (
  SELECT s.*, CASE WHEN d.c_custkey IS NULL THEN 'new' ELSE 'changed' END AS change_type
  FROM staged s LEFT JOIN dim1 d ON s.c_custkey = d.c_custkey
  WHERE d.c_custkey IS NULL OR s.hash_value <> d.hash_value),
ch AS (
  SELECT *, (SELECT max(customer_key) FROM dim1) + row_number() OVER (ORDER BY c_custkey) AS customer_key FROM ch0)"""

DIM2 = f"""
dim2 AS (
  SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment, d.hash_value, d.customer_key,
         d.start_date,
         CASE WHEN c.c_custkey IS NULL THEN d.end_date ELSE CAST(DATE '{AS_OF_2[:10]}' AS DATE) END AS end_date,
         c.c_custkey IS NULL AS is_current, d.created_at,
         CASE WHEN c.c_custkey IS NULL THEN d.updated_at ELSE TIMESTAMP '{AS_OF_2}' END AS updated_at
  FROM dim1 d LEFT JOIN (SELECT c_custkey FROM ch WHERE change_type = 'changed') c ON d.c_custkey = c.c_custkey
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, hash_value, customer_key,
         CAST(DATE '{AS_OF_2[:10]}' AS DATE), CAST(NULL AS DATE), TRUE,
         TIMESTAMP '{AS_OF_2}', TIMESTAMP '{AS_OF_2}'
  FROM ch)"""

ORDER_TEXT = """
  SELECT CAST(o_orderkey AS VARCHAR) AS Order_Key, o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         o_totalprice, o_orderdate,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS Order_Date,
         o_orderpriority = '5-LOW' AS bad_date, o_orderpriority = '4-NOT SPECIFIED' AS bad_price
  FROM orders"""


def _required_columns() -> str:
    parts = []
    for name, required in SCHEMA_CHECKS.items():
        missing = [c for c in required if c not in TABLE_REQUIRED[name]]
        status = "FAIL" if missing else "PASS"
        message = "NULL" if not missing else "'" + str(missing).replace("'", "''") + "'"
        parts.append(
            f"SELECT '{name}' AS table_name, 'schema_check' AS check_name, '{status}' AS status, "
            f"CAST({len(missing)} AS BIGINT) AS failed_records, CAST({message} AS VARCHAR) AS message, "
            f"count(*) AS total_records FROM {name}"
        )
    return "\nUNION ALL\n".join(parts)


def _expectations() -> str:
    parts = []
    for name, keys in TABLE_KEYS.items():
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count, "
            f"(SELECT count(*) FROM {name}) > 0 AS has_rows, TRUE AS has_required_columns, "
            f"(SELECT count(*) FROM (SELECT {k} FROM {name} GROUP BY {k} HAVING count(*) > 1)) AS duplicate_keys"
        )
    return "\nUNION ALL\n".join(parts)


def _job_metrics() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'bronze_{t}' AS job_name, 'SUCCESS' AS status, count(*) AS records_processed, "
        f"CAST(NULL AS VARCHAR) AS error FROM {t}"
        for t in METRIC_TABLES
    )


RUN_LOG = """
runs AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS layer, 'order_' || CAST(o_custkey AS VARCHAR) AS job_name,
         o_orderstatus, o_orderdate AS start_time, CAST(floor(o_totalprice) AS BIGINT) AS amount
  FROM orders),
state AS (
  SELECT run_id, layer, job_name,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS status,
         CASE WHEN o_orderstatus = 'F' THEN start_time + INTERVAL 1 DAY ELSE start_time END AS event_time,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN amount ELSE 0 END AS records,
         CASE WHEN o_orderstatus = 'P' THEN 'partial shipment' END AS error
  FROM runs)"""


ORACLE: dict[str, str] = {
    "conform_orders": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
               o_orderstatus, o_orderpriority
        FROM orders""",
    "conform_valid": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
               o_orderstatus, o_orderpriority
        FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')""",
    "rejects_bad_casts": f"""
        WITH t AS ({ORDER_TEXT})
        SELECT Order_Key, Order_Date,
               'Invalid value: ' || CASE WHEN bad_date THEN 'o_orderdate' ELSE 'o_totalprice' END AS reject_reason
        FROM t WHERE bad_date OR bad_price""",
    "flatten_json": """
        SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k FROM events""",
    "flatten_xml": """
        SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "union_three_sources": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'a'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'b' ELSE 'c' END AS source
        FROM customer""",
    "incremental_filter": f"""
        SELECT event_type, max(ts) AS new_mark, count(*) AS n_rows FROM events
        WHERE ts > TIMESTAMP '{MARK_LO}' AND ts <= TIMESTAMP '{MARK_HI}'
        GROUP BY event_type""",
    "incremental_rows": f"""
        SELECT event_id, user_id, event_type, ts FROM events
        WHERE ts > TIMESTAMP '{MARK_LO}' AND ts <= TIMESTAMP '{MARK_HI}'""",
    "latest_mark": """
        SELECT event_type AS pipeline_name, 'user_' || CAST(user_id AS VARCHAR) AS pipeline_destination,
               arg_max(date_trunc('hour', ts), ts) AS ingestion_time, max(ts) AS updated_at
        FROM events GROUP BY 1, 2""",
    "anti_join_new": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderstatus = 'F'
                          AND s.o_orderkey = o.o_orderkey AND s.o_custkey = o.o_custkey)""",
    "anti_join_null_keys": """
        WITH t AS (
          SELECT o_orderkey, o_orderpriority,
                 CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS close_date
          FROM orders)
        SELECT o_orderkey, close_date FROM t
        WHERE NOT EXISTS (SELECT 1 FROM t s WHERE s.o_orderpriority IN ('1-URGENT', '2-HIGH')
                          AND s.o_orderkey = t.o_orderkey AND s.close_date IS NOT DISTINCT FROM t.close_date)""",
    "latest_per_key": """
        SELECT user_id, event_id, ts, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "null_report": """
        SELECT *, CASE WHEN failed_records > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM (
        WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal FROM customer)
        SELECT 'c_custkey' AS "column", count(*) AS total_records, count(*) FILTER (WHERE c_custkey IS NULL) AS failed_records FROM c
        UNION ALL SELECT 'c_name', count(*), count(*) FILTER (WHERE c_name IS NULL) FROM c
        UNION ALL SELECT 'c_acctbal', count(*), count(*) FILTER (WHERE c_acctbal IS NULL) FROM c)""",
    "positive_report": """
        SELECT *, CASE WHEN failed_records > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM (
        SELECT 'c_acctbal' AS "column", count(*) AS total_records,
               count(*) FILTER (WHERE c_acctbal <= 0) AS failed_records FROM customer
        UNION ALL SELECT 'c_nationkey', count(*), count(*) FILTER (WHERE c_nationkey <= 0) FROM customer)""",
    "required_columns": _required_columns(),
    "dup_key_valid": """
        WITH t AS (SELECT o_orderkey, o_custkey,
                          CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day
                   FROM orders)
        SELECT o_orderkey, o_custkey, order_day FROM t
        QUALIFY count(*) OVER (PARTITION BY o_custkey, order_day) = 1""",
    "dup_key_rejected": """
        WITH t AS (SELECT o_orderkey, o_custkey,
                          CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day
                   FROM orders)
        SELECT o_orderkey, o_custkey, order_day, 'Duplicate business key' AS reject_reason FROM t
        QUALIFY count(*) OVER (PARTITION BY o_custkey, order_day) > 1""",
    "dup_groups": "SELECT p_name, count(*) AS n_rows FROM part GROUP BY p_name HAVING count(*) > 1",
    "expectations_report": _expectations(),
    "row_hash": f"""
        SELECT p_partkey,
               sha256(to_json([p_name, CASE WHEN p_size >= 10 THEN p_brand END, p_type,
                               CAST(p_size AS VARCHAR), {_dec('p_retailprice')}])) AS hash_value
        FROM part""",
    "row_hash_doubles": """
        SELECT c_custkey, c_acctbal * 1e-9 <> c_acctbal * 1e-9 * (1 + pow(2.0, -50)) AS tiny_next,
               c_acctbal <> 0 AS tiny_huge, TRUE AS nan_none, TRUE AS nan_balance, FALSE AS same_balance
        FROM customer""",
    "scd2_null_key": f"""
        SELECT CASE WHEN c_nationkey <> 0 THEN c_custkey END AS c_custkey, c_name, c_acctbal, TRUE AS is_current,
               DATE '{AS_OF_1[:10]}' AS start_date, CAST(NULL AS DATE) AS end_date
        FROM customer
        QUALIFY row_number() OVER (PARTITION BY CASE WHEN c_nationkey <> 0 THEN c_custkey END ORDER BY c_name DESC) = 1""",
    "surrogate_keys": """
        SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_nationkey, c_custkey) AS customer_key
        FROM customer""",
    "scd2_first_load": f"WITH {DIM1} SELECT * FROM dim1",
    "scd2_changes": f"WITH {DIM1}, {CHANGES} SELECT c_custkey, change_type, customer_key FROM ch",
    "scd2_second_load": f"WITH {DIM1}, {CHANGES}, {DIM2} SELECT * FROM dim2",
    "scd2_current": f"WITH {DIM1}, {CHANGES}, {DIM2} SELECT * FROM dim2 WHERE is_current",
    "fact_load": f"""
        WITH {DIM1}
        SELECT d.customer_key, o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate,
               TIMESTAMP '{AS_OF_1}' AS created_at
        FROM orders o LEFT JOIN dim1 d ON o.o_custkey = d.c_custkey""",
    "fact_missing_dim": f"""
        WITH d AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key
                   FROM customer WHERE c_nationkey <> 0)
        SELECT d.customer_key, o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate,
               TIMESTAMP '{AS_OF_1}' AS created_at
        FROM orders o LEFT JOIN d ON o.o_custkey = d.c_custkey""",
    "fact_point_in_time": f"""
        WITH {DIM1}, {CHANGES}, {DIM2},
        f AS (SELECT o_orderkey, o_custkey,
                     CAST(CASE WHEN o_orderstatus = 'O' THEN DATE '{AS_OF_2[:10]}' ELSE DATE '{AS_OF_1[:10]}' END AS DATE)
                       AS fact_date
              FROM orders)
        SELECT d.customer_key, f.o_orderkey, f.o_custkey, f.fact_date, TIMESTAMP '{AS_OF_2}' AS created_at
        FROM f LEFT JOIN dim2 d ON f.o_custkey = d.c_custkey AND d.start_date <= f.fact_date
             AND (d.end_date IS NULL OR f.fact_date < d.end_date)""",
    "clean_rules": """
        SELECT p_partkey, lower(trim('  ' || upper(p_name) || ' ')) AS p_name,
               lower(trim(p_type || ' ')) AS p_type, p_retailprice,
               CASE WHEN p_retailprice >= 1000 THEN 'Premium' WHEN p_retailprice >= 500 THEN 'Standard'
                    ELSE 'Budget' END AS price_band
        FROM part""",
    "gold_metrics": """
        SELECT o.o_custkey, c.c_name, round(sum(o.o_totalprice), 2) AS price_sum,
               count(*) AS n_orders, max(o.o_totalprice) AS price_max
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY 1, 2""",
    "threshold_prompts": f"""
        SELECT o_orderkey,
               'Order ' || CAST(o_orderkey AS VARCHAR) || ' of customer ' || CAST(o_custkey AS VARCHAR) || ' costs ' ||
               CAST(o_totalprice AS VARCHAR) || ', has status ' || o_orderstatus || ' and priority ' ||
               o_orderpriority || '.' || {NL} || 'Is its price plausible? Answer yes or no with one reason.' AS prompt
        FROM orders WHERE o_totalprice > {REVIEW_PRICE}""",
    "enrich_deterministic": f"""
        SELECT doc_id, sha256('Summarize the following ' || lang || ' text from ' || source || ':' || {NL} || text)
               AS ai_result
        FROM documents""",
    "update_by_key": """
        SELECT o_orderkey AS run_id, o_orderpriority AS layer, 'order_' || CAST(o_custkey AS VARCHAR) AS job_name,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS status,
               o_orderdate AS start_time,
               CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 1 DAY END AS end_time,
               CASE WHEN o_orderstatus IN ('F', 'P') THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS records,
               CASE WHEN o_orderstatus = 'P' THEN 'partial shipment' END AS error
        FROM orders""",
    "run_log_latest": f"WITH {RUN_LOG} SELECT * FROM state",
    "audit_events": f"""
        WITH {RUN_LOG}
        SELECT run_id, 'START' AS event, 'start ' || job_name AS message FROM state
        UNION ALL SELECT run_id, 'END', 'records ' || CAST(records AS VARCHAR) FROM state WHERE status = 'SUCCESS'
        UNION ALL SELECT run_id, 'ERROR', error FROM state WHERE status = 'FAILED'""",
    "job_metrics": _job_metrics(),
}
