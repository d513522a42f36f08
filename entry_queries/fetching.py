"""Incremental fetch strategies, cursors and soft delete."""

from datetime import datetime

from pyspark.sql import functions as F

from entry_queries.inputs import landed_customers, table
from entry_queries.registry import query
from landfall.functions.timestamps import format_cursor
from landfall.operators import incremental as I
from landfall.operators.merge import merge_upsert
from landfall.operators.tombstone import absent_keys, mark_deleted, mark_deleted_counts
from landfall.plans.warehouse import Warehouse
from landfall.session import scratch_folder

LAST = datetime(2000, 12, 31)
FLOOR = datetime(1998, 1, 1)
AS_OF = datetime(2001, 8, 1)
LOOKBACK = 300

LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"


@query("full_refresh", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer WHERE c_acctbal >= 0 OR c_mktsegment <> 'BUILDING'
""")
def full_refresh_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    landed = customers.filter(F.col("c_acctbal") >= 0)
    fetched = customers.filter(F.col("c_mktsegment") != "BUILDING").withColumn(
        "c_acctbal", F.col("c_acctbal") + 1
    )
    return I.full_refresh(landed, fetched, ("c_custkey",))


@query("rolling_refetch", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 6 MONTH
            THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
""")
def rolling_refetch_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    window = I.rolling_refetch(orders, "o_orderdate", AS_OF, months=6)
    fetched = window.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge_upsert(orders, fetched, ["o_orderkey"])


@query("search_window", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-12-31' - INTERVAL 300 SECOND
""")
def search_window_query(spark, sf_dir):
    return I.search_window(table(spark, sf_dir, "orders"), "o_orderdate", LAST, LOOKBACK)


@query("cursor_missing_policy", """
WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS updated_at
  FROM orders)
SELECT 'include' AS policy, * FROM o
WHERE updated_at >= TIMESTAMP '2000-12-31' OR updated_at IS NULL
UNION ALL
SELECT 'exclude', * FROM o WHERE updated_at >= TIMESTAMP '2000-12-31'
UNION ALL
SELECT 'raise', * FROM o WHERE updated_at >= TIMESTAMP '2000-12-31'
""")
def cursor_missing_policy_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("updated_at"),
    )
    inputs = {"include": orders, "exclude": orders,
              "raise": orders.filter(F.col("updated_at").isNotNull())}
    include, exclude, strict = [
        I.admit_since(rows, "updated_at", LAST, policy).select(
            F.lit(policy).alias("policy"), "o_orderkey", "updated_at"
        )
        for policy, rows in inputs.items()
    ]
    return include.unionByName(exclude).unionByName(strict)


@query("initial_value", """
SELECT 'first' AS run, o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL
SELECT 'later', o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-12-31'
UNION ALL
SELECT 'unbounded', o_orderkey FROM orders
""")
def initial_value_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first, later, unbounded = [
        I.search_window(orders, "o_orderdate", state, initial_value=floor).select(
            F.lit(run).alias("run"), "o_orderkey"
        )
        for run, state, floor in (
            ("first", None, FLOOR), ("later", LAST, FLOOR), ("unbounded", None, None)
        )
    ]
    return first.unionByName(later).unionByName(unbounded)


@query("parent_fanout", """
SELECT o.* FROM orders o SEMI JOIN customer c ON o_custkey = c_custkey AND c_acctbal > 0
WHERE o_orderdate >= TIMESTAMP '1998-01-01' - INTERVAL 300 SECOND
""")
def parent_fanout_query(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    return I.parent_fanout(
        table(spark, sf_dir, "orders"), parents, "o_custkey", "c_custkey",
        cursor="o_orderdate", last=FLOOR, lookback_seconds=LOOKBACK,
    )


@query("parent_watermark", f"""
SELECT {LINE_SQL}, o_orderdate AS _order_changed_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate >= TIMESTAMP '1998-01-01' - INTERVAL 300 SECOND
""")
def parent_watermark_query(spark, sf_dir):
    worklist = I.changed_parents(
        table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate", FLOOR, LOOKBACK
    )
    lines = table(spark, sf_dir, "lineitem").select(*LINE_SQL.split(", "))
    return I.parent_watermark(
        lines, worklist, "l_orderkey", "o_orderkey", "o_orderdate", "_order_changed_at"
    )


@query("advance_watermark", """
WITH w AS (SELECT o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS moved
           FROM orders)
SELECT 'advances' AS run,
       greatest(TIMESTAMP '1998-01-01', max(coalesce(moved, TIMESTAMP '1970-01-01'))) AS watermark
FROM w
UNION ALL
SELECT 'stays', greatest(TIMESTAMP '2030-01-01', max(coalesce(moved, TIMESTAMP '1970-01-01')))
FROM w
UNION ALL
SELECT 'only nulls', greatest(TIMESTAMP '1970-01-01', max(coalesce(moved, TIMESTAMP '1970-01-01')))
FROM w WHERE o_orderstatus = 'P'
""")
def advance_watermark_query(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("at"),
    )
    advances, stays, nulls = [
        I.advance_watermark(
            I.changed_parents(rows, "o_orderkey", "at", None), "at", watermark
        ).select(F.lit(run).alias("run"), "watermark")
        for run, rows, watermark in (
            ("advances", parents, FLOOR), ("stays", parents, datetime(2030, 1, 1)),
            ("only nulls", parents.filter(F.col("o_orderstatus") == "P"), None),
        )
    ]
    return advances.unionByName(stays).unionByName(nulls)


@query("backfill_window", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def backfill_window_query(spark, sf_dir):
    return I.backfill_window(
        table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 10), datetime(2024, 1, 20)
    )


@query("cursor_state", """
SELECT event_type AS source, 'r' || user_id AS resource,
       CASE WHEN value >= 50 THEN 'production' ELSE 'trial' END AS destination,
       arg_max(ts, (ts, CAST(event_id AS VARCHAR))) AS cursor, max(ts) AS saved_at
FROM events GROUP BY ALL
""")
def cursor_state_query(spark, sf_dir):
    states = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("resource"),
        F.when(F.col("value") >= 50, F.lit("production")).otherwise(F.lit("trial"))
        .alias("destination"),
        F.col("ts").alias("cursor"),
        F.col("event_id").cast("string").alias("load_id"),
        F.col("ts").alias("saved_at"),
    )
    return I.cursor_state(states)


@query("format_cursor", """
SELECT event_id,
       strftime(ts - INTERVAL 300 SECOND, '%Y-%m-%d %H:%M:%S') AS as_text,
       epoch_us(ts - INTERVAL 300 SECOND) // 1000 AS as_millis
FROM events
""")
def format_cursor_query(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        format_cursor(F.col("ts"), "text", LOOKBACK).alias("as_text"),
        format_cursor(F.col("ts"), "epoch_ms", LOOKBACK).alias("as_millis"),
    )


@query("recover_pending", """
SELECT o_orderkey, o_orderstatus, year(o_orderdate) AS load_year,
       CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'recovered' ELSE 'landed' END AS via
FROM orders
""")
def recover_pending_query(spark, sf_dir):
    """The load of the later years is prepared, and its driver is lost before it is switched
    in; the next run finds and finishes it."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("load_year")
    )
    late = F.col("load_year") >= 2000

    class Lost(Warehouse):
        def _switch(self, *args):
            raise ConnectionError("the driver is gone")

    root = scratch_folder(spark, "recover")
    warehouse = Warehouse(root, "shop", buckets=8)
    warehouse.land("orders", orders.filter(~late).withColumn("via", F.lit("landed")), ["o_orderkey"], "L1")
    try:
        Lost(root, "shop", buckets=8).land(
            "orders", orders.filter(late).withColumn("via", F.lit("recovered")), ["o_orderkey"], "L2")
    except ConnectionError:
        warehouse.recover(spark)
    return warehouse.read(spark, "orders")


LANDED_SQL = """
WITH landed AS (
  SELECT c_custkey, c_mktsegment, c_acctbal < 0 AS _deleted,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'L' || (c_nationkey % 5) END AS _load_id
  FROM customer)
"""
STALE_SQL = "_load_id NOT IN ('L1', 'L2') AND NOT _deleted"


@query("mark_deleted", LANDED_SQL + f"""
SELECT c_custkey, c_mktsegment, _load_id,
       CASE WHEN {STALE_SQL} THEN true ELSE _deleted END AS _deleted
FROM landed
""")
def mark_deleted_query(spark, sf_dir):
    return mark_deleted(landed_customers(spark, sf_dir), ["L1", "L2"])


@query("mark_deleted_counts", LANDED_SQL + f"""
SELECT 'customer' AS table_name, count(*) FILTER (WHERE {STALE_SQL}) AS marked FROM landed
UNION ALL
SELECT 'supplier', count(*) FILTER (WHERE s_nationkey % 5 NOT IN (1, 2)) FROM supplier
UNION ALL
SELECT 'never_landed', 0
""")
def mark_deleted_counts_query(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.lit(False).alias("_deleted"),
        F.concat(F.lit("L"), (F.col("s_nationkey") % 5).cast("string")).alias("_load_id"),
    )
    return mark_deleted_counts(
        spark,
        {"customer": landed_customers(spark, sf_dir), "supplier": suppliers,
         "never_landed": None},
        ["L1", "L2"],
    )


@query("absent_keys", "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def absent_keys_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return absent_keys(customers, customers.filter(F.col("c_acctbal") >= 0), ["c_custkey"])
