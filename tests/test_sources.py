"""Envelopes and chains of pages."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.contract import Resource
from landfall.operators.checks import SPARK_ERRORS
from landfall.operators.shape import shape
from landfall.sources.envelope import (
    chain_complete,
    chain_ends,
    numbered_chain_gaps,
    page_chain_gaps,
    read_bodies,
    records_as_columns,
    scan_envelope,
    scan_envelope_auto,
    scan_pages_numbered,
)
from landfall.sources.tables import ensure_database, present_tables, scan_projected, table_scan


def pages(spark, *rows, schema="resource string, page int, body string"):
    return spark.createDataFrame(
        [(*row[:-1], json.dumps(row[-1]) if not isinstance(row[-1], str) else row[-1])
         for row in rows], schema)


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_records_come_from_the_declared_path(spark):
    df = pages(spark, ("r", 1, {"out": {"data": [{"id": 1, "x": {"y": 2}}, {"id": 2}]}}),
               ("r", 2, {"out": {"data": []}}), ("r", 3, {"out": None}), ("r", 4, {}))
    rows = scan_envelope(df, "out.data", "id bigint, x struct<y: bigint>", keep=["page"])
    assert bag(rows, "page", "id", "x.y") == [(1, 1, 2), (1, 2, None)]


@pytest.mark.parametrize("body", ["<html>502</html>", '{"data": [{"id": 1}', ""])
def test_a_body_that_is_not_json_raises(spark, body):
    df = pages(spark, ("r", 1, body))
    if body == "":
        assert scan_envelope(df, "data", "id bigint").count() == 0
    else:
        with pytest.raises(SPARK_ERRORS):
            scan_envelope(df, "data", "id bigint").collect()


def test_the_list_is_found_whatever_its_key(spark):
    df = pages(
        spark,
        ("messages", 1, {"messages": [{"id": 1}, {"id": 2}], "next": "c2"}),
        ("types", 1, {"types": [{"id": 3}], "errors": []}),
        ("null", 1, {"collections": None}),
        ("text", 1, {"note": "[1]"}),
        ("bare", 1, [{"id": 4}]),
        ("types", 2, {"types": [{"id": 5}], "errors": ["x", "y", "z"]}),
        ("deep", 1, {"data": {"items": [{"id": 6}]}, "next": "c"}),
        ("empty", 1, {"items": []}),
    )
    found = scan_envelope_auto(df, keep=["resource"], endpoint=["resource"]).select(
        "resource", "list_key", F.try_variant_get("record", "$.id", "bigint").alias("id"))
    assert bag(found, "resource", "list_key", "id") == [
        ("bare", None, 4), ("deep", "data.items", 6), ("messages", "messages", 1),
        ("messages", "messages", 2), ("types", "types", 3), ("types", "types", 5)]


def test_a_choice_of_lists_is_an_error_that_a_selector_settles(spark):
    df = pages(spark, ("tie", 1, {"b": [{"id": 6}], "a": [{"id": 5}]}))
    with pytest.raises(Exception, match="a, b"):
        scan_envelope_auto(df).collect()
    assert bag(scan_envelope_auto(df, selector="b"), "list_key") == [("b",)]


def test_found_records_can_be_shaped(spark):
    df = pages(spark, ("mail", 1, {"mails": [
        {"id": "m1", "created": 1785485066, "metrics": {"opened": 1785485074, "link:7": 5},
         "campaign": 17},
        {"id": "m2", "created": 1785485066000, "metrics": {"opened": "2026-07-31T08:04:34Z"}},
        {"id": "m3"},
    ]}))
    records = records_as_columns(
        scan_envelope_auto(df).drop("list_key"),
        "id string, created variant, metrics variant, campaign bigint")
    resource = Resource(
        "mails", ("id",), timestamp_columns=("created",), hint_columns=("created", "opened_at"),
        promote={"metrics.opened": "opened_at"})
    rows = sorted(records.transform(shape(resource)).collect())
    assert [r.created for r in rows] == [datetime(2026, 7, 31, 8, 4, 26)] * 2 + [None]
    assert [r.opened_at for r in rows] == [datetime(2026, 7, 31, 8, 4, 34)] * 2 + [None]
    assert json.loads(rows[0].metrics) == {"opened": 1785485074, "link:7": 5}
    assert [r.campaign for r in rows] == [17, None, None] and rows[2].metrics is None


def body(ids, total=None):
    return {"items": [{"id": i} for i in ids], "_meta": {"pageCount": total}}


def test_a_numbered_chain_ends_at_its_count_or_at_an_empty_page(spark):
    df = pages(
        spark,
        ("counted", 1, body([1], 2)), ("counted", 2, body([2], 2)), ("counted", 3, body([3], 2)),
        ("grown", 1, body([1], 1)), ("grown", 2, body([2], 2)),
        ("uncounted", 1, {"items": [{"id": 1}]}), ("uncounted", 2, {"items": []}),
        ("uncounted", 3, {"items": [{"id": 3}]}),
        ("endless", 1, {"items": [{"id": 1}]}),
        (None, 1, body([9], 1)), (None, 2, body([10], 1)),
    )
    rows = scan_pages_numbered(df, ["resource"], "items", "id bigint")
    assert bag(rows, "resource", "id") == [
        ("counted", 1), ("counted", 2), ("endless", 1), ("grown", 1), ("uncounted", 1),
        (None, 9)]
    gaps = numbered_chain_gaps(
        df.filter("NOT (resource = 'counted' AND page = 1) OR resource IS NULL"), ["resource"],
        chain_ends(df, ["resource"], "items", "_meta.pageCount"))
    assert bag(gaps, "resource", "pages_read") == [("counted", 1), ("endless", 1)]


CURSOR = "resource string, cursor_in string, next string, items int"


def test_gaps_of_a_cursor_chain(spark):
    df = spark.createDataFrame([
        # whole: the last page with rows still names a next one, which is empty
        ("whole", None, "c2", 2), ("whole", "c2", "c3", 1), ("whole", "c3", "", 0),
        ("single", None, None, 5),
        ("lost", None, "c2", 2), ("lost", "c3", "", 1),
        ("beyond", None, "c2", 0), ("beyond", "c2", None, 3),
    ], CURSOR)
    gaps = page_chain_gaps(df)
    assert bag(gaps, "resource", "token", "problem") == [
        ("beyond", "c2", "past_end"), ("lost", "c2", "dangling_next"), ("lost", "c3", "past_end")]
    assert bag(chain_complete(df, gaps), "resource", "complete") == [
        ("beyond", False), ("lost", False), ("single", True), ("whole", True)]


def test_a_projection_may_lose_columns_but_not_its_key(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, at string, v string")
    assert scan_projected(df, ["id", "at", "gone"], ["id", "at"]).columns == ["id", "at"]
    for fields in (["at"], ["id"]):
        with pytest.raises(ValueError, match="loses"):
            scan_projected(df, fields, ["id", "at"])


def test_bodies_are_read_per_line_or_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data":\n [{"id": 1}]}')
    (tmp_path / "b.json").write_text('{"data":\n [{"id": 2}]}')
    whole = read_bodies(spark, str(tmp_path), one_per_file=True)
    assert bag(scan_envelope(whole, "data", "id bigint"), "id") == [(1,), (2,)]
    assert read_bodies(spark, str(tmp_path)).count() == 4


def test_tables_of_a_database(spark):
    assert present_tables(spark, "raw_nowhere") == set()
    ensure_database(spark, "raw_probe2")
    ensure_database(spark, "raw_probe2")
    spark.range(3).write.saveAsTable("raw_probe2.t")
    assert present_tables(spark, "raw_probe2") == {"t"}
    assert table_scan(spark, "raw_probe2", "t").count() == 3
    spark.sql("DROP DATABASE raw_probe2 CASCADE")
