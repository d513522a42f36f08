"""What stretches of time are covered, and cursors that follow them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from entry_queries.inputs import table
from entry_queries.registry import query
from landfall.contract import Contract, run_window
from landfall.operators.ranges import covered_until, islands
from landfall.plans.load import run_source
from landfall.plans.warehouse import Warehouse
from landfall.session import scratch_folder


def order_ranges(spark, sf_dir):
    """An interval per order: from its day on, up to twelve hours long; of every customer a few."""
    day = F.col("o_orderdate").cast("timestamp")
    hours = F.col("o_orderkey") % 13
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), (F.col("o_custkey") % 20).cast("string")).alias("resource"),
        F.when(F.col("o_orderkey") % 97 != 0, day).alias("range_start"),
        F.when(F.col("o_orderkey") % 89 != 0, F.timestamp_add("HOUR", hours * 3 - 2, day)).alias("range_end"),
        F.when(hours > 5, F.timestamp_add("HOUR", hours - 5, day)).alias("newest"))


RANGES_SQL = """
WITH r AS (
  SELECT 'c' || (o_custkey % 20) AS resource,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate::TIMESTAMP END AS range_start,
         CASE WHEN o_orderkey % 89 <> 0
              THEN o_orderdate::TIMESTAMP + to_hours(((o_orderkey % 13) * 3 - 2)::INT) END AS range_end,
         CASE WHEN o_orderkey % 13 > 5 THEN o_orderdate::TIMESTAMP + to_hours(((o_orderkey % 13) - 5)::INT) END AS newest
  FROM orders),
"""


@query("covered_ranges", RANGES_SQL + """
u AS (SELECT * FROM r WHERE range_end IS NOT NULL AND (range_start IS NULL OR range_start <= range_end)),
b AS (
  SELECT *, max(range_end) OVER (
    PARTITION BY resource ORDER BY range_start NULLS FIRST, range_end
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM u),
n AS (
  SELECT *, sum(CASE WHEN range_start > before THEN 1 ELSE 0 END) OVER (
    PARTITION BY resource ORDER BY range_start NULLS FIRST, range_end
    ROWS UNBOUNDED PRECEDING) AS island FROM b)
SELECT resource, CASE WHEN count(range_start) = count(*) THEN min(range_start) END AS range_start,
       max(range_end) AS range_end, max(newest) AS newest, count(*) AS pieces
FROM n GROUP BY resource, island
""")
def covered_ranges_query(spark, sf_dir):
    found = islands(order_ranges(spark, sf_dir), ["resource"])
    moments = ("range_start", "range_end", "newest")
    return found.withColumns({name: F.col(name).cast("timestamp_ntz") for name in moments})


@query("covered_until", RANGES_SQL + """
known AS (SELECT DISTINCT resource FROM r),
u AS (
  SELECT * FROM r WHERE range_end IS NOT NULL AND (range_start IS NULL OR range_start <= range_end)
  UNION ALL
  SELECT resource, NULL, TIMESTAMP '1996-01-01', TIMESTAMP '1996-01-01' FROM known),
b AS (
  SELECT *, max(range_end) OVER (
    PARTITION BY resource ORDER BY range_start NULLS FIRST, range_end
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM u),
g AS (SELECT resource, min(range_start) AS gap FROM b WHERE range_start > before GROUP BY resource)
SELECT u.resource, max(newest) AS newest
FROM u LEFT JOIN g USING (resource)
WHERE gap IS NULL OR range_start IS NULL OR range_start < gap GROUP BY u.resource
""")
def covered_until_query(spark, sf_dir):
    found = covered_until(order_ranges(spark, sf_dir), ["resource"], datetime(1996, 1, 1))
    return found.withColumn("newest", F.col("newest").cast("timestamp_ntz"))


SHOP = Contract.from_dict({
    "name": "windows",
    "api": {"base_url": "https://shop.invalid", "auth": {"type": "bearer", "token_env": "T"}},
    "resources": [{
        "name": "orders", "primary_key": "o_orderkey",
        "incremental": {"strategy": "search_window", "cursor_field": "o_orderdate",
                        "initial_value": "1995-01-01"}}],
})
WINDOWS = ("1995-01-01", "1996-07-01", "1998-03-01", "2000-01-01")


@query("windows_in_any_order", """
SELECT o.name AS "order", max(o_orderdate)::TIMESTAMP AS "cursor"
FROM orders, (VALUES ('forward'), ('backward'), ('mixed'), ('gap')) o(name)
WHERE o_orderdate < CASE WHEN o.name = 'gap' THEN TIMESTAMP '1996-07-01' ELSE TIMESTAMP '2000-01-01' END
GROUP BY ALL
""")
def windows_in_any_order_query(spark, sf_dir):
    """Three backfill windows landed in some order give one cursor; without the middle one, the first's."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    bounds = [datetime.fromisoformat(day) for day in WINDOWS]
    now, told = datetime(2024, 5, 1), []
    for name, order in (("forward", (0, 1, 2)), ("backward", (2, 1, 0)), ("mixed", (1, 2, 0)), ("gap", (2, 0))):
        warehouse = Warehouse(scratch_folder(spark, "windows"), SHOP.name, buckets=4)
        for hour, i in enumerate(order):
            run_source(spark, SHOP, warehouse, {"orders": orders}, run_window(now, start=bounds[i], end=bounds[i + 1]),
                       f"w{i}", now + timedelta(hours=hour))
        told.append((name, warehouse.cursor(spark, "orders")))
    return spark.createDataFrame(told, "order string, cursor timestamp").withColumn(
        "cursor", F.col("cursor").cast("timestamp_ntz"))
