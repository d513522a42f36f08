"""What the plans must look like to hold at scale."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.contract import Contract
from landfall.operators import checks as C, incremental as I
from landfall.operators.merge import dedup_latest, merge_statement, merge_upsert
from landfall.operators.requests import request_family
from landfall.operators.runlog import latest_verdict
from landfall.operators.shape import sample_landed, shape
from landfall.plans.warehouse import Warehouse
from landfall.session import configure


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders") / "o")
    spark.range(5000).select(
        F.col("id"), (F.col("id") % 50).alias("customer"), F.lit("x").alias("note"),
        F.timestamp_seconds(F.col("id") * 3600).alias("at"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_cursor_bounds_reach_the_file_scan(orders):
    bounded = I.search_window(orders, "at", datetime(1970, 3, 1), 300)
    assert "PushedFilters: [Or(GreaterThanOrEqual(at," in plan(bounded)
    window = I.backfill_window(orders, "at", datetime(1970, 2, 1), datetime(1970, 3, 1))
    assert "LessThan(at," in plan(window) and "GreaterThanOrEqual(at," in plan(window)
    shaped = bounded.transform(shape(Contract.from_dict({
        "name": "s", "api": {"base_url": "b", "auth": {"type": "t", "token_env": "e"}},
        "resources": [{"name": "o", "primary_key": "id", "timestamp_columns": ["at"]}],
    }).resources[0]))
    assert "PushedFilters: [Or(" in plan(shaped) and "Exchange" not in plan(shaped)


def test_ranking_keeps_one_row_per_key_before_the_shuffle(orders):
    for ranked in (
        dedup_latest(orders, ["customer"], "at"),
        latest_verdict(orders.select(
            F.col("customer").alias("asset"), F.lit("e").alias("expectation"),
            F.lit("c").alias("column_name"), F.col("note").alias("description"),
            F.col("at").alias("validated_at"))),
    ):
        text = plan(ranked)
        exchange = text.index("Exchange hashpartitioning")
        assert "Partial" in text[exchange:] and "WindowGroupLimit" in text[exchange:]


def test_a_sample_is_a_top_n_not_a_sort(orders):
    assert "TakeOrderedAndProject" in plan(sample_landed(orders, ("id",), 5))


def test_a_suite_reads_a_table_twice_at_most(spark, orders):
    checks = [*C.identity("o", ("id",)), C.not_null("o", "note"), C.not_null("o", "customer"),
              C.freshness("o", "at", 5)]
    text = plan(C.evaluate(spark, {"o": orders}, checks, "raw_s", datetime(2024, 1, 1)))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    # The grouping by key reads nothing but the key.
    assert any("ReadSchema: struct<id:bigint>" in line for line in scans)
    # The other pass moves one row per task.
    assert text.count("hashpartitioning(id") == 1


def test_routes_cost_no_join_and_no_grouping(orders):
    families = orders.select(request_family(F.col("note"), {"/a": "a", "/a/b": "b"}))
    assert "Join" not in plan(families) and "Exchange" not in plan(families)


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_parent_with_most_children_is_split(spark, orders, small_skew_limits):
    children = spark.range(0, 40000, 1, 8).select(
        F.col("id").alias("child"),
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("parent"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    )
    worklist = I.changed_parents(orders, "id", "at", None)
    rows = I.parent_watermark(children, worklist, "parent", "id", "at", "_at")
    assert rows.agg(F.count_distinct("child")).first()[0] == 40000
    rows.write.format("noop").mode("overwrite").save()
    executed = rows.persist()
    try:
        executed.count()
        assert "isSkewJoin=true" in plan(executed) or "skew=true" in plan(executed)
    finally:
        executed.unpersist()


def test_a_merge_reads_and_writes_only_the_buckets_it_touches(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=16)
    warehouse.land("t", spark.range(2000).select("id", F.lit("a").alias("v")), ["id"], "L1")
    def files():
        found = {}
        for file in (tmp_path / "raw_s" / "t").glob("*/*.parquet"):
            found.setdefault(file.parent.name, set()).add(file.name)
        return found

    before = files()
    assert len(before) == 16 and all(len(names) == 1 for names in before.values())
    warehouse.land("t", spark.range(1, 2).select("id", F.lit("b").alias("v")), ["id"], "L2")
    after = files()
    assert sum(before[bucket] != after[bucket] for bucket in before) == 1
    assert all(len(names) <= 2 for names in after.values())
    rows = warehouse.read(spark, "t")
    assert rows.count() == 2000 and rows.filter("v = 'b'").count() == 1


def test_a_merge_moves_the_target_once(spark, tmp_path, small_skew_limits, monkeypatch):
    warehouse = Warehouse(str(tmp_path), "s", buckets=16)
    rows = spark.range(2000).select("id", F.lit("a").alias("v"))
    warehouse.land("t", rows, ["id"], "L1")
    seen = []
    monkeypatch.setattr(Warehouse, "_write_parts",
                        lambda self, df, path, by: seen.append(plan(df)) or df.write.partitionBy(
                            *by).parquet(path))
    warehouse.land("t", rows.filter("id < 500"), ["id"], "L2")
    text = seen[0]
    assert "SortMergeJoin" in text and "PartitionFilters: [_bucket_of_16" in text
    # One each for the target, the load, and the load's keys; the rest moves rows without a key,
    # for which the scan of the target is bounded by the files' statistics.
    keyed = [part for part in text.split("Exchange hashpartitioning(id")[1:] if "isnotnull(id" in part[:900]]
    assert len(keyed) >= 2 and "PushedFilters: [IsNull(id)]" in text
    assert warehouse.read(spark, "t").count() == 2000


def test_a_load_is_reduced_once_before_it_moves(orders):
    merged = merge_upsert(orders, orders.filter("customer < 5"), ["id"], "at")
    text = plan(merged)
    assert "LeftAnti" in text and "WindowGroupLimit" in text


def test_orphans_are_counted_from_reduced_keys(orders):
    text = plan(C.orphan_keys(orders, "customer", orders, "id"))
    assert text.count("partial_count(1)") == 1 and "LeftAnti" in text


def test_shuffles_start_wide_enough_for_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, 2**40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
        configure(spark, 10)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_merge_statement_is_valid(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    parsed = parser.parsePlan(merge_statement("raw_s.t", "delta", ["a", "b"])).toString()
    assert "MergeIntoTable" in parsed
