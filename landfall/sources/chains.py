"""Which pages of a cursor chain are reached from its first page.

Following a chain page by page takes as many steps as it has pages. Here jumps double in
length each round, so a chain of n pages is settled in log n rounds of joins on
(chain, token): a chain that holds a third of all pages is spread by its tokens like any
other, and pages that only lead to each other, in a loop, are reached by nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from landfall.operators.joins import join_null_safe
from landfall.session import scratch_folder

_EDGE = ("_chain", "_at")


def _named(chain: Sequence[str], token: Column) -> tuple[Column, Column]:
    """A chain and a page of it as texts that are never null, so joins stay plain."""
    name = F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(chain)]))
    page = F.when(token.isNull(), F.lit("first")).otherwise(F.concat(F.lit("token "), token))
    return name.alias("_chain"), page.alias("_at")


def followed_links(pages: DataFrame, chain: Sequence[str]) -> DataFrame:
    """``(chain..., cursor_in, token)``: a page with rows and the next page it names."""
    return pages.filter((F.col("items") > 0) & (F.coalesce("next", F.lit("")) != "")).select(
        *chain, "cursor_in", F.col("next").alias("token"))


def _kept(df: DataFrame) -> DataFrame:
    folder = scratch_folder(df.sparkSession, "chain-round")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def reached_pages(pages: DataFrame, chain: Sequence[str]) -> DataFrame:
    """``(_chain, _at)`` of every landed page that its chain's first page leads to, itself included.

    After round k all pages less than 2^k steps away are reached, and a jump spans 2^k pages.
    Jumps to pages already reached tell nothing new and are dropped, so the
    rounds shrink; they end when no page is added. Every round is written, so a lost
    executor never repeats an earlier one.
    """
    landed = pages.select(*_named(chain, F.col("cursor_in"))).distinct()
    links = followed_links(pages, chain)
    jumps = links.select(*_named(chain, F.col("cursor_in")), _named(chain, F.col("token"))[1].alias("_to")).distinct()
    jumps = _kept(jumps.join(
        landed.withColumnRenamed("_at", "_to"), ["_chain", "_to"], "left_semi").select("_chain", "_at", "_to"))
    reached = _kept(landed.filter("_at = 'first'"))
    while True:
        news = jumps.join(reached, list(_EDGE), "left_semi").select("_chain", F.col("_to").alias("_at")).distinct()
        news = _kept(news.join(reached, list(_EDGE), "left_anti"))
        if news.isEmpty():
            return reached
        reached = reached.unionAll(news)
        onward = jumps.select("_chain", F.col("_at").alias("_to"), F.col("_to").alias("_end"))
        jumps = _kept(
            jumps.join(onward, ["_chain", "_to"])
            .select("_chain", "_at", F.col("_end").alias("_to")).distinct()
            .join(reached.withColumnRenamed("_at", "_to"), ["_chain", "_to"], "left_anti")
            .select("_chain", "_at", "_to"))


def chain_breaks(pages: DataFrame, chain: Sequence[str] = ("resource",)) -> DataFrame:
    """What keeps a cursor chain from being whole, by what its first page leads to.

    Pages are rows of the columns ``chain``, ``cursor_in`` (null on the first page), ``next`` and
    ``items`` (their number). ``dangling_next``: a reached page with rows names a page that
    never landed. ``past_end``: a landed page that the first does not lead to: after a gap, after an
    empty page, or in a loop of its own. A chain whose first page never landed has all of
    its pages past its end. A page that leads back to one before it is no break: nothing is missing.
    """
    at = _named(chain, F.col("cursor_in"))
    reached = reached_pages(pages, chain)
    landed = pages.filter(F.col("cursor_in").isNotNull()).select(
        *chain, F.col("cursor_in").alias("token"), *at).distinct()
    past = landed.join(reached, list(_EDGE), "left_anti").select(*chain, "token")
    told = followed_links(pages, chain).select(*chain, "token", *at).distinct()
    told = told.join(reached, list(_EDGE), "left_semi").select(*chain, "token").distinct()
    dangling = join_null_safe(told, landed.select(*chain, "token"), [*chain, "token"], "left_anti")
    return dangling.withColumn("problem", F.lit("dangling_next")).unionByName(
        past.withColumn("problem", F.lit("past_end")))
