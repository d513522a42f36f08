"""The situations the queries need, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The key of each table; conversations and lineitem need several columns.
KEYS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",),
    "supplier": ("s_suppkey",), "part": ("p_partkey",), "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"), "events": ("event_id",),
    "documents": ("doc_id",), "embeddings": ("vec_id",), "pages": ("page_id",),
    "benchmark": ("item_id",), "labels": ("doc_id",), "conversations": ("conv_id", "turn"),
}

PAGE_SIZE = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wall_clock(moment: Column) -> Column:
    """A result timestamp without a zone, as the given tables hold theirs."""
    return moment.cast("timestamp_ntz")


def k_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def page_number() -> Column:
    return F.floor(F.col("event_id") / PAGE_SIZE) + 1


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as response pages: ``resource``, ``page``, ``items`` (an array of
    records, one page long at most) and ``pages``, the resource's last page."""
    record = F.struct(
        "event_id", "user_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"), "props",
    )
    pages = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("resource"), page_number().alias("page"))
        .agg(F.collect_list(record).alias("items"))
    )
    last = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("resource"))
        .agg(F.max(page_number()).alias("pages"))
    )
    return pages.join(last, "resource")


def verdict_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as verdicts: one check per event type on one table per user."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("validated_at"),
        F.concat(F.lit("raw_shop.t"), F.col("user_id").cast("string")).alias("asset"),
        F.lit("unexpected_rows_expectation").alias("expectation"),
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.col("event_type"), F.lit(" holds")).alias("description"),
        ((F.col("event_type") != "error") | (k_of() >= 50)).alias("success"),
        "event_id",
    )


def landed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed by five loads; some flagged, some without a load id."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        (F.col("c_acctbal") < 0).alias("_deleted"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY",
            F.concat(F.lit("L"), (F.col("c_nationkey") % 5).cast("string")),
        ).alias("_load_id"),
    )
