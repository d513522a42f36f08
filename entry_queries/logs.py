"""Run log, counts, schema changes and request counts."""

from pyspark.sql import functions as F

from entry_queries.inputs import TABLES, k_of, landed_customers, table, verdict_log, wall_clock
from entry_queries.registry import query
from landfall.operators.requests import request_family, requests_by_family
from landfall.operators.runlog import (
    failures_for_asset,
    first_failure,
    latest_verdict,
    observed_schema,
    record_run,
    rows_this_run,
    run_summary,
    schema_changes,
    table_counts,
)

LOG_SQL = """
WITH log AS (
  SELECT ts AS validated_at, 'raw_shop.t' || user_id AS asset,
         event_type || ' holds' AS description,
         event_type <> 'error' OR CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50
           AS success, event_id
  FROM events)
"""
LOG_COLUMNS = ("validated_at", "asset", "description", "success", "event_id")

ROUTES = {"/fr/": "french", "/en/": "english", "/en/2": "english_two", "/de/": "german"}
FAMILY_SQL = r"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (
  SELECT page_id, CASE WHEN contains(path, '/en/2') THEN 'english_two'
                       WHEN contains(path, '/fr/') THEN 'french'
                       WHEN contains(path, '/en/') THEN 'english'
                       WHEN contains(path, '/de/') THEN 'german'
                       ELSE 'unmatched' END AS family
  FROM p)
"""


@query("latest_verdict", LOG_SQL + """
SELECT * FROM log QUALIFY row_number() OVER (
  PARTITION BY asset, description ORDER BY validated_at DESC, event_id DESC) = 1
""")
def latest_verdict_query(spark, sf_dir):
    log = verdict_log(spark, sf_dir)
    return latest_verdict(log, order=("validated_at", "event_id")).select(*LOG_COLUMNS)


@query("failures_for_asset", LOG_SQL + """
SELECT * FROM log WHERE asset = 'raw_shop.t7' AND NOT success
""")
def failures_for_asset_query(spark, sf_dir):
    return failures_for_asset(verdict_log(spark, sf_dir), "raw_shop.t7").select(*LOG_COLUMNS)


@query("first_failure", LOG_SQL + """
SELECT * EXCLUDE (before) FROM (
  SELECT *, lag(success) OVER (PARTITION BY asset, description ORDER BY validated_at, event_id)
    AS before
  FROM log)
WHERE before AND NOT success
""")
def first_failure_query(spark, sf_dir):
    return first_failure(verdict_log(spark, sf_dir), tiebreak=["event_id"]).select(*LOG_COLUMNS)


@query("table_counts", "\nUNION ALL\n".join(
    [f"SELECT '{name}' AS table_name, count(*) AS total FROM {name}" for name in TABLES]
    + ["SELECT 'never_landed', NULL"]
))
def table_counts_query(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    return table_counts(spark, {**tables, "never_landed": None})


def landed_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("L"), F.year("o_orderdate").cast("string")).alias("_load_id")
    )


THIS_RUN_SQL = """
SELECT 'customer' AS table_name, count(*) AS rows_this_run FROM customer
WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey % 5 IN (1, 2)
UNION ALL
SELECT 'orders', count(*) FROM orders WHERE year(o_orderdate) = 2000
"""


def this_run(spark, sf_dir):
    tables = {"customer": landed_customers(spark, sf_dir),
              "orders": landed_orders(spark, sf_dir), "returns": None}
    return rows_this_run(spark, tables, ["L1", "L2", "L2000"])


@query("rows_this_run", THIS_RUN_SQL)
def rows_this_run_query(spark, sf_dir):
    return this_run(spark, sf_dir)


@query("run_summary", f"""
WITH n AS ({THIS_RUN_SQL})
SELECT c.table_name, coalesce(n.rows_this_run, 0) AS rows_this_run, c.total
FROM (SELECT 'customer' AS table_name, count(*) AS total FROM customer
      UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'part', count(*) FROM part
      UNION ALL SELECT 'returns', NULL) c LEFT JOIN n USING (table_name)
""")
def run_summary_query(spark, sf_dir):
    counted = {name: table(spark, sf_dir, name) for name in ("customer", "orders", "part")}
    counted["_ledger"] = table(spark, sf_dir, "labels")
    counts = table_counts(spark, {**counted, "returns": None})
    return run_summary(counts, this_run(spark, sf_dir))


@query("record_run", """
WITH n AS (
  SELECT user_id, event_type, count(*) AS n, min(ts) AS first_ts FROM events GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS dag_run_id,
       CASE WHEN user_id % 2 = 0 THEN min(first_ts) END AS started_at,
       CAST(sum(n) AS DOUBLE) AS elapsed_seconds,
       '[' || string_agg('"' || event_type || '"', ',' ORDER BY event_type) || ']' AS resources,
       '[]' AS load_ids,
       '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}'
         AS rows_this_run,
       '{}' AS requests_by_family
FROM n GROUP BY user_id
""")
def record_run_query(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts")
    )
    entries = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    started = F.date_format(F.min("first_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    summaries = counts.groupBy("user_id").agg(
        F.col("user_id").cast("string").alias("dag_run_id"),
        F.when(F.col("user_id") % 2 == 0, started).otherwise(F.lit("soon")).alias("started_at"),
        F.sum("n").cast("double").alias("elapsed_seconds"),
        F.array_sort(F.collect_list("event_type")).alias("resources"),
        F.map_from_entries(entries).alias("rows_this_run"),
        F.lit(None).cast("map<string,bigint>").alias("requests_by_family"),
    )
    return record_run(summaries).select(
        "dag_run_id", wall_clock(F.col("started_at")).alias("started_at"), "elapsed_seconds",
        "resources", "load_ids", "rows_this_run", "requests_by_family",
    )


@query("schema_changes", """
WITH seen AS (
  SELECT DISTINCT unnest(CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15'
                              THEN ['event_id', 'user_id', 'kind', 'amount']
                              ELSE ['event_id', 'user_id', 'kind'] END) AS column_name,
         ts >= TIMESTAMP '2024-01-15' AS late
  FROM events),
typed AS (
  SELECT DISTINCT column_name, late,
         CASE WHEN column_name = 'kind' THEN 'STRING'
              WHEN column_name = 'user_id' AND late THEN 'STRING' ELSE 'BIGINT' END AS data_type
  FROM seen)
SELECT 'events' AS table_name, column_name, data_type FROM typed WHERE late
EXCEPT
SELECT 'events', column_name, data_type FROM typed WHERE NOT late
""")
def schema_changes_query(spark, sf_dir):
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    amount = F.when(late & (F.col("event_type") == "purchase"), k_of())
    body = F.when(
        late,
        F.to_json(F.struct(
            "event_id", F.col("user_id").cast("string").alias("user_id"),
            F.col("event_type").alias("kind"), amount.alias("amount"),
        )),
    ).otherwise(F.to_json(F.struct("event_id", "user_id", F.col("event_type").alias("kind"))))
    records = table(spark, sf_dir, "events").select(
        late.alias("late"), F.parse_json(body).alias("record")
    )
    return schema_changes(
        observed_schema(records.filter("late"), "events"),
        observed_schema(records.filter("NOT late"), "events"),
    )


@query("request_family", FAMILY_SQL + "SELECT page_id, family FROM f")
def request_family_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", request_family(F.col("url"), ROUTES).alias("family")
    )


@query("requests_by_family", FAMILY_SQL + """
SELECT family, count(*) AS requests FROM f GROUP BY family
""")
def requests_by_family_query(spark, sf_dir):
    return requests_by_family(table(spark, sf_dir, "pages"), "url", ROUTES)
