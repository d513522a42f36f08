"""Chains of pages followed from their first page, and pages landed by contract alone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from entry_queries.inputs import event_pages, page_number, table
from entry_queries.registry import query
from landfall.contract import Contract, run_window
from landfall.plans.load import run_source
from landfall.plans.warehouse import Warehouse
from landfall.session import scratch_folder
from landfall.sources.chains import chain_breaks
from landfall.sources.envelope import chain_complete
from landfall.sources.landed import chains_complete


def looped_pages(spark, sf_dir):
    """A cursor chain per event type. Every seventh page of views and clicks leads back to the
    page three before it, so what follows is only reached within loops; one
    page of purchases never landed, and one of errors is empty."""
    counts = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("resource"), page_number().alias("page")
    ).agg(F.count(F.lit(1)).alias("items"))
    last = counts.groupBy("resource").agg(F.max("page").alias("pages"))
    page = F.col("page")
    back = F.col("resource").isin("view", "click") & (page % 7 == 0)
    ahead = F.when(back, page - 3).when(page < F.col("pages"), page + 1)
    return counts.join(last, "resource").filter(
        ~((F.col("resource") == "purchase") & (page == 4))
    ).select(
        "resource",
        F.when(page > 1, F.concat(F.lit("p"), page.cast("string"))).alias("cursor_in"),
        F.concat(F.lit("p"), ahead.cast("string")).alias("next"),
        F.when((F.col("resource") == "error") & (page == 3), F.lit(0)).otherwise(F.col("items")).alias("items"),
    )


BREAKS_SQL = """
WITH RECURSIVE c AS (
  SELECT event_type AS resource, event_id // 200 + 1 AS page, count(*) AS n FROM events GROUP BY ALL),
l AS (SELECT resource, max(page) AS pages FROM c GROUP BY ALL),
p AS (
  SELECT resource, page,
         CASE WHEN resource IN ('view', 'click') AND page % 7 = 0 THEN page - 3
              WHEN page < pages THEN page + 1 END AS ahead,
         CASE WHEN resource = 'error' AND page = 3 THEN 0 ELSE n END AS items
  FROM c JOIN l USING (resource) WHERE NOT (resource = 'purchase' AND page = 4)),
r AS (
  SELECT resource, page FROM p WHERE page = 1
  UNION
  SELECT p.resource, p.ahead FROM r JOIN p USING (resource, page)
  WHERE p.items > 0 AND p.ahead IS NOT NULL),
g AS (
  SELECT resource, 'p' || page AS token, 'dangling_next' AS problem
  FROM r WHERE (resource, page) NOT IN (SELECT (resource, page) FROM p)
  UNION ALL
  SELECT resource, 'p' || page, 'past_end'
  FROM p WHERE page > 1 AND (resource, page) NOT IN (SELECT (resource, page) FROM r))
"""


@query("chain_breaks", BREAKS_SQL + "SELECT resource, token, problem FROM g")
def chain_breaks_query(spark, sf_dir):
    return chain_breaks(looped_pages(spark, sf_dir))


@query("chain_complete_followed", BREAKS_SQL + """
SELECT resource, resource NOT IN (SELECT resource FROM g) AS complete FROM l
""")
def chain_complete_followed_query(spark, sf_dir):
    pages = looped_pages(spark, sf_dir)
    return chain_complete(pages, chain_breaks(pages))


SHOP = Contract.from_dict({
    "name": "pages_shop",
    "api": {"base_url": "https://shop.invalid", "auth": {"type": "bearer", "token_env": "T"}},
    "pagination": {
        "kind": {"type": "page_number", "base_page": 1, "page_param": "page", "total_path": "_meta.pageCount"},
        "data_selector": "items"},
    "resources": [
        {"name": name, "primary_key": "event_id", "soft_delete": "always",
         "endpoint": {"params": {"fields": "event_id,user_id,at,props"}},
         "timestamp_columns": ["at"]}
        for name in ("click", "purchase")
    ],
})


def shop_pages(spark, sf_dir):
    """Responses as they landed: a JSON body for each page. Page 2 of purchases is missing."""
    body = F.to_json(F.struct("items", F.struct(F.col("pages").alias("pageCount")).alias("_meta")))
    pages = event_pages(spark, sf_dir).select("resource", "page", body.alias("body"))
    return pages.filter(~((F.col("resource") == "purchase") & (F.col("page") == 2)))


@query("land_pages", """
SELECT event_type AS resource, event_id, user_id, ts AS at, json_extract_string(props, '$.k')::BIGINT AS k,
       false AS _deleted
FROM events WHERE event_type = 'click' OR event_type = 'purchase' AND event_id // 200 <> 1
""")
def land_pages_query(spark, sf_dir):
    """From landed pages to landed tables by contract alone."""
    warehouse = Warehouse(scratch_folder(spark, "land-pages"), SHOP.name, buckets=8)
    now = datetime(2024, 5, 1)
    run_source(spark, SHOP, warehouse, None, run_window(now), "r1", now, pages=shop_pages(spark, sf_dir))
    landed = None
    for name in SHOP.resource_names:
        rows = warehouse.read(spark, name).select(
            F.lit(name).alias("resource"), "event_id", "user_id", F.col("at").cast("timestamp_ntz").alias("at"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"), "_deleted")
        landed = rows if landed is None else landed.unionByName(rows)
    return landed


@query("pages_complete", """
WITH c AS (SELECT event_type AS resource, event_id // 200 + 1 AS page FROM events GROUP BY ALL)
SELECT resource, count(*) FILTER (WHERE NOT (resource = 'purchase' AND page = 2)) = max(page) AS complete
FROM c WHERE resource IN ('click', 'purchase') GROUP BY resource
""")
def pages_complete_query(spark, sf_dir):
    """Whether the chains of each table were read whole, told by the pages and the contract."""
    pages = shop_pages(spark, sf_dir)
    told = [(r.name, chains_complete(pages, SHOP, r)) for r in SHOP.resources]
    return spark.createDataFrame(told, "resource string, complete boolean")
