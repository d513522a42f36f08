"""Write dispositions."""

from pyspark.sql import functions as F

from entry_queries.inputs import table, verdict_log
from entry_queries.registry import query
from landfall.operators.merge import dedup_latest, evolve_add_columns, merge_upsert
from landfall.plans.suite import write_append
from landfall.plans.warehouse import Warehouse
from landfall.session import scratch_folder

# The newest of each key by ship date, the other columns in order breaking ties.
NEWEST_LINE = """row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus) = 1"""


@query("merge_upsert", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
""")
def merge_upsert_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    loaded = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    changed = orders.filter(
        F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    ).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge_upsert(loaded, changed, ["o_orderkey"], cursor="o_orderdate")


@query("merge_null_keys", """
WITH o AS (SELECT nullif(o_orderkey % 50, 0) AS bucket, o_orderkey, o_totalprice, o_orderdate FROM orders)
SELECT bucket, o_orderkey, o_totalprice, o_orderdate FROM o
WHERE bucket IS NULL AND o_orderdate >= TIMESTAMP '2000-01-01'
UNION ALL
SELECT * FROM (
  SELECT bucket, o_orderkey, o_totalprice, o_orderdate FROM o
  WHERE bucket IS NOT NULL AND o_orderdate >= TIMESTAMP '2000-01-01')
QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def merge_null_keys_query(spark, sf_dir):
    """A delta with many rows without a key, merged twice over older ones."""
    orders = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderkey") % 50, F.lit(0)).alias("bucket"), "o_orderkey", "o_totalprice",
        F.struct(F.col("o_orderdate"), (-F.col("o_orderkey")).alias("k")).alias("version"),
    )
    new = F.col("version.o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    delta = orders.filter(new)
    once = merge_upsert(dedup_latest(orders.filter(~new), ["bucket"], "version"), delta, ["bucket"], "version")
    twice = merge_upsert(once, delta, ["bucket"], "version")
    return twice.select("bucket", "o_orderkey", "o_totalprice", "version.o_orderdate")


@query("merge_upsert_composite", f"""
WITH delta AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-06-01')
SELECT t.* FROM lineitem t
  ANTI JOIN delta d USING (l_orderkey, l_linenumber)
  WHERE t.l_shipdate < TIMESTAMP '2000-01-01'
UNION ALL
SELECT * FROM delta QUALIFY {NEWEST_LINE}
""")
def merge_upsert_composite_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate")
    loaded = lines.filter(shipped < F.lit("2000-01-01").cast("timestamp_ntz"))
    delta = lines.filter(shipped >= F.lit("1999-06-01").cast("timestamp_ntz"))
    return merge_upsert(loaded, delta, ["l_orderkey", "l_linenumber"], cursor="l_shipdate")


@query("dedup_latest", f"SELECT * FROM lineitem QUALIFY {NEWEST_LINE}")
def dedup_latest_query(spark, sf_dir):
    return dedup_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], cursor="l_shipdate"
    )


@query("write_replace", "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'")
def write_replace_query(spark, sf_dir):
    warehouse = Warehouse(scratch_folder(spark, "replace"), "shop")
    customers = table(spark, sf_dir, "customer")
    later = customers.filter(F.col("c_mktsegment") != "BUILDING")
    for load_id, rows in (("L1", customers), ("L2", later)):
        warehouse.land("customer", rows, ["c_custkey"], load_id, disposition="replace")
    return warehouse.read(spark, "customer")


@query("write_append", """
SELECT ts AS validated_at, 'raw_shop.t' || user_id AS asset,
       event_type || ' holds' AS description,
       event_type <> 'error' OR CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50
         AS success
FROM events
""")
def write_append_query(spark, sf_dir):
    log = verdict_log(spark, sf_dir).select("validated_at", "asset", "description", "success")
    folder = scratch_folder(spark, "append")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    write_append(log.filter(F.col("validated_at") < half), folder, "validated_at")
    write_append(log.filter(F.col("validated_at") >= half), folder, "validated_at")
    return spark.read.parquet(folder).drop("_day")


@query("evolve_type_conflict", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS v,
       CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS v__v_double,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS v__v_string
FROM orders
""")
def evolve_type_conflict_query(spark, sf_dir):
    """A column that arrives as a whole number, then as a fraction, then as text."""
    warehouse = Warehouse(scratch_folder(spark, "types"), "shop", buckets=8)
    orders = table(spark, sf_dir, "orders")
    for load, column in enumerate(("o_custkey", "o_totalprice", "o_orderpriority")):
        part = orders.filter(F.col("o_orderkey") % 3 == load)
        warehouse.land("orders", part.select("o_orderkey", F.col(column).alias("v")),
                       ["o_orderkey"], f"L{load}")
    return warehouse.read(spark, "orders")


@query("evolve_type_lattice", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_custkey::DOUBLE END AS price,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
            WHEN o_orderkey % 3 = 1 THEN o_custkey::VARCHAR
            ELSE CASE WHEN o_custkey > 75 THEN 'true' ELSE 'false' END END AS label,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 100 ELSE o_orderkey * 3000000000 END AS whole,
       CASE WHEN o_orderkey % 3 < 2 THEN (o_custkey % 1000)::DOUBLE ELSE o_totalprice END AS part,
       CAST(CAST((o_custkey % 1000) / 4 AS DECIMAL(20, 2)) AS DOUBLE) AS amount
FROM orders
""")
def evolve_type_lattice_query(spark, sf_dir):
    """Columns whose types drift both ways between loads land in the least type that holds them."""
    warehouse = Warehouse(scratch_folder(spark, "lattice"), "shop", buckets=8)
    orders = table(spark, sf_dir, "orders")
    quarter = F.expr("(o_custkey % 1000) / 4")
    loads = (
        {"price": F.col("o_totalprice"), "label": F.col("o_orderpriority"),
         "whole": F.expr("cast(o_custkey % 100 as int)"), "part": F.expr("cast(o_custkey % 1000 as int)"),
         "amount": quarter.cast("decimal(7,2)")},
        {"price": F.col("o_custkey"), "label": F.col("o_custkey"),
         "whole": F.expr("o_orderkey * 3000000000"), "part": F.expr("cast(o_custkey % 1000 as smallint)"),
         "amount": quarter.cast("decimal(20,4)")},
        {"price": F.expr("cast(o_custkey as int)"), "label": F.expr("o_custkey > 75"),
         "whole": F.expr("o_orderkey * 3000000000"), "part": F.col("o_totalprice"),
         "amount": quarter.cast("decimal(6,3)")},
    )
    for load, columns in enumerate(loads):
        part = orders.filter(F.col("o_orderkey") % 3 == load)
        warehouse.land("orders", part.select("o_orderkey", *[c.alias(n) for n, c in columns.items()]),
                       ["o_orderkey"], f"L{load}")
    return warehouse.read(spark, "orders").withColumn("amount", F.col("amount").cast("double"))


@query("evolve_add_columns", """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'error'
            ELSE coalesce(nullif(o_orderpriority, '5-LOW'), 'error') END AS severity,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderstatus END AS description
FROM orders
""")
def evolve_add_columns_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    shipped = F.lit("1998-01-01").cast("timestamp_ntz")
    before = orders.filter(F.col("o_orderdate") < shipped).select("o_orderkey", "o_totalprice")
    after = orders.filter(F.col("o_orderdate") >= shipped).select(
        "o_orderkey", "o_totalprice",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("severity"),
        F.col("o_orderstatus").alias("description"),
    )
    log = before.unionByName(after, allowMissingColumns=True)
    return evolve_add_columns(
        log, {"severity": ("string", "error"), "description": ("string", None)}
    )
