"""Scans: envelopes, page chains, projected and whole tables."""

from pyspark.sql import functions as F

from entry_queries.inputs import PAGE_SIZE, event_pages, page_number, table
from entry_queries.registry import query
from landfall.sources.envelope import (
    chain_complete,
    numbered_chain_gaps,
    chain_ends,
    page_chain_gaps,
    scan_envelope,
    scan_envelope_auto,
    scan_pages_numbered,
)
from landfall.sources.tables import ensure_database, scan_projected, table_scan

RECORD = "event_id bigint, user_id bigint, at string"


def bodies(pages, total):
    """Pages with a JSON body: the items, and the page count where one is given."""
    body = F.to_json(F.struct("items", F.struct(total.alias("pageCount")).alias("_meta")))
    return pages.select("resource", "page", body.alias("body"))


@query("scan_envelope", """
SELECT event_type AS resource, event_id, user_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at
FROM events
""")
def scan_envelope_query(spark, sf_dir):
    pages = bodies(event_pages(spark, sf_dir), F.col("pages"))
    return scan_envelope(pages, "items", RECORD, keep=["resource"])


@query("scan_envelope_auto", """
SELECT event_type AS list_key, event_id AS id, user_id AS other FROM events
UNION ALL
SELECT 'data.regions', r_regionkey, NULL FROM region
""")
def scan_envelope_auto_query(spark, sf_dir):
    # Two lists a page, the second longer on some pages.
    tags = F.transform(F.sequence(F.lit(1), F.pmod(F.col("page"), F.lit(3)) * 200 + 1),
                       lambda i: i.cast("string"))
    events = event_pages(spark, sf_dir).select(
        F.col("resource").alias("endpoint"),
        F.concat(F.lit('{"tags":'), F.to_json(tags), F.lit(',"'), "resource", F.lit('":'),
                 F.to_json("items"), F.lit("}")).alias("body"),
    )
    regions = (
        table(spark, sf_dir, "region")
        .groupBy(F.floor(F.col("r_regionkey") / PAGE_SIZE).alias("page"))
        .agg(F.collect_list(F.struct("r_regionkey", "r_name")).alias("regions"))
        .select(
            F.lit("regions").alias("endpoint"),
            F.to_json(F.struct(F.struct("regions").alias("data"), F.lit("x").alias("next"))).alias("body"),
        )
    )
    empty = table(spark, sf_dir, "nation").select(
        F.lit("nations").alias("endpoint"),
        F.to_json(
            F.struct("n_nationkey", F.lit(None).cast("string").alias("collections")),
            {"ignoreNullFields": "false"},
        ).alias("body")
    )
    found = scan_envelope_auto(
        events.unionByName(regions).unionByName(empty), endpoint=["endpoint"]
    )

    def number(path):
        return F.try_variant_get("record", path, "bigint")

    return found.select(
        "list_key",
        F.coalesce(number("$.event_id"), number("$.r_regionkey")).alias("id"),
        number("$.user_id").alias("other"),
    )


def numbered_pages(spark, sf_dir):
    """Page counts two short of what landed; none for errors, whose last page but
    one is empty instead."""
    pages = event_pages(spark, sf_dir)
    error = F.col("resource") == "error"
    emptied = error & (F.col("page") == F.col("pages") - 1)
    pages = pages.withColumn(
        "items", F.when(emptied, F.slice("items", 1, 0)).otherwise(F.col("items"))
    )
    return bodies(pages, F.when(~error, F.col("pages") - 2))


@query("scan_pages_numbered", """
WITH e AS (
  SELECT event_type AS resource, event_id // 200 + 1 AS page, event_id, user_id,
         max(event_id // 200 + 1) OVER (PARTITION BY event_type) AS pages
  FROM events)
SELECT resource, page, event_id, user_id FROM e WHERE page <= pages - 2
""")
def scan_pages_numbered_query(spark, sf_dir):
    return scan_pages_numbered(
        numbered_pages(spark, sf_dir), ["resource"], "items",
        "event_id bigint, user_id bigint",
    )


@query("numbered_chain_gaps", """
WITH e AS (
  SELECT event_type AS resource, event_id // 200 + 1 AS page, count(*) AS n
  FROM events WHERE NOT (event_type = 'click' AND event_id // 200 + 1 = 2)
  GROUP BY ALL),
ends AS (
  SELECT event_type AS resource, max(event_id // 200 + 1) - 2 AS last_page
  FROM events GROUP BY ALL)
SELECT resource, last_page, count(*) FILTER (WHERE page <= last_page) AS pages_read
FROM e JOIN ends USING (resource) WHERE resource = 'click' GROUP BY ALL
""")
def numbered_chain_gaps_query(spark, sf_dir):
    pages = numbered_pages(spark, sf_dir).filter(
        ~((F.col("resource") == "click") & (F.col("page") == 2))
    )
    ends = chain_ends(pages, ["resource"], "items", "_meta.pageCount")
    return numbered_chain_gaps(pages, ["resource"], ends).withColumn(
        "last_page", F.col("last_page").cast("bigint")
    )


def cursor_pages(spark, sf_dir):
    """A cursor chain per event type. One page of clicks never landed; one page of
    errors is empty although it names a next one."""
    counts = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("resource"), page_number().alias("page")
    ).agg(F.count(F.lit(1)).alias("items"))
    last = counts.groupBy("resource").agg(F.max("page").alias("pages"))

    def token(page):
        return F.concat(F.lit("p"), page.cast("string"))

    chain = counts.join(last, "resource").select(
        "resource",
        "page",
        F.when(F.col("page") > 1, token(F.col("page"))).alias("cursor_in"),
        F.when(F.col("page") < F.col("pages"), token(F.col("page") + 1))
        .otherwise(F.lit("")).alias("next"),
        F.when((F.col("resource") == "error") & (F.col("page") == 3), F.lit(0))
        .otherwise(F.col("items")).alias("items"),
    )
    return chain.filter(~((F.col("resource") == "click") & (F.col("page") == 2)))


GAPS_SQL = """
WITH c AS (
  SELECT event_type AS resource, event_id // 200 + 1 AS page, count(*) AS n
  FROM events GROUP BY ALL),
l AS (SELECT resource, max(page) AS pages FROM c GROUP BY ALL),
p AS (
  SELECT resource, CASE WHEN page > 1 THEN 'p' || page END AS cursor_in,
         CASE WHEN page < pages THEN 'p' || (page + 1) ELSE '' END AS next,
         CASE WHEN resource = 'error' AND page = 3 THEN 0 ELSE n END AS items
  FROM c JOIN l USING (resource) WHERE NOT (resource = 'click' AND page = 2)),
f AS (SELECT resource, next AS token FROM p WHERE items > 0 AND next <> ''),
a AS (SELECT resource, cursor_in AS token FROM p WHERE cursor_in IS NOT NULL),
g AS (
  SELECT *, 'dangling_next' AS problem FROM (SELECT * FROM f EXCEPT SELECT * FROM a)
  UNION ALL
  SELECT *, 'past_end' FROM (SELECT * FROM a EXCEPT SELECT * FROM f))
"""


@query("page_chain_gaps", GAPS_SQL + "SELECT resource, token, problem FROM g")
def page_chain_gaps_query(spark, sf_dir):
    return page_chain_gaps(cursor_pages(spark, sf_dir))


@query("chain_complete", GAPS_SQL + """
SELECT resource, resource NOT IN (SELECT resource FROM g) AS complete FROM l
""")
def chain_complete_query(spark, sf_dir):
    pages = cursor_pages(spark, sf_dir)
    return chain_complete(pages, page_chain_gaps(pages))


@query("scan_projected", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def scan_projected_query(spark, sf_dir):
    wanted = ["o_orderkey", "o_custkey", "o_orderdate", "o_salesperson"]
    return scan_projected(
        table(spark, sf_dir, "orders"), wanted, required=["o_orderkey", "o_orderdate"]
    )


@query("table_scan", "SELECT * FROM lineitem")
def table_scan_query(spark, sf_dir):
    ensure_database(spark, "shop_scan")
    spark.sql("DROP TABLE IF EXISTS shop_scan.lineitem")
    spark.catalog.createTable("shop_scan.lineitem", path=f"{sf_dir}/lineitem.parquet", source="parquet")
    return table_scan(spark, "shop_scan", "lineitem")
