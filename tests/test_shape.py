"""Records to rows: timestamps, JSON text, promotion, HTML, names, tombstones."""

import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from landfall.contract import Resource
from landfall.functions.html import html_text, strip_html
from landfall.functions.naming import snake_case, snake_case_columns
from landfall.functions.text import truncate_observed, url_path
from landfall.functions.timestamps import format_cursor, parse_timestamp
from landfall.operators.shape import (
    contain_open_map,
    flatten_json,
    landed_rows,
    promote_fields,
    sample_landed,
    shape,
)


def parsed(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(parse_timestamp(F.col("v"), df.schema["v"].dataType)).first()[0]


INSTANT = datetime(2026, 7, 31, 8, 4, 26)


@pytest.mark.parametrize("value, kind, expected", [
    ("2026-07-31T08:04:26Z", "string", INSTANT),
    ("2026-07-31T10:04:26+02:00", "string", INSTANT),
    ("2026-07-31 08:04:26", "string", INSTANT),
    ("20260731T080426Z", "string", INSTANT),
    ("20260731T0804", "string", INSTANT.replace(second=0)),
    ("2026-07-31", "string", datetime(2026, 7, 31)),
    ("20260731", "string", datetime(2026, 7, 31)),
    ("", "string", None),
    (None, "string", None),
    (1785485066, "bigint", INSTANT),
    (1785485066000, "bigint", INSTANT),
    (1785485066, "int", INSTANT),
    (1785485066123.0, "double", INSTANT.replace(microsecond=123000)),
    (1785485066.5, "double", INSTANT.replace(microsecond=500000)),
    (0, "bigint", datetime(1970, 1, 1)),
    (10**12, "bigint", datetime(2001, 9, 9, 1, 46, 40)),
    (-(10**12), "bigint", datetime(1938, 4, 24, 22, 13, 20)),
    (10**9, "bigint", datetime(2001, 9, 9, 1, 46, 40)),
    (None, "bigint", None),
    (True, "boolean", True),
    (INSTANT, "timestamp", INSTANT),
])
def test_parse_timestamp(spark, value, kind, expected):
    assert parsed(spark, value, kind) == expected


@pytest.mark.parametrize("text", ["soon", " ", "2026-13-01", "1785485066"])
def test_text_that_is_no_timestamp_raises(spark, text):
    with pytest.raises(PySparkException, match="not a timestamp"):
        parsed(spark, text, "string")


def test_a_json_field_of_mixed_types_is_parsed_by_what_it_holds(spark):
    values = ["1785485066", "1785485066000", '"2026-07-31T08:04:26Z"', "1785485066.0", "null",
              '""']
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, j string")
    df = df.select("i", F.parse_json("j").alias("v"))
    rows = df.select("i", parse_timestamp(F.col("v"), T.VariantType()).alias("t")).collect()
    assert [row.t for row in sorted(rows)] == [INSTANT] * 4 + [None, None]
    with pytest.raises(PySparkException, match="not a timestamp"):
        df.select(parse_timestamp(F.parse_json(F.lit('{"a": 1}')), T.VariantType())).collect()


def test_cursors_are_formatted_after_the_lookback(spark):
    df = spark.createDataFrame([(INSTANT,)], "t timestamp")
    text, millis = df.select(
        format_cursor(F.col("t"), "text", 3600), format_cursor(F.col("t"), "epoch_ms", 300)
    ).first()
    assert text == "2026-07-31 07:04:26"
    assert millis == 1785485066000 - 300_000
    with pytest.raises(ValueError):
        format_cursor(F.col("t"), "iso")


NESTED = """id bigint, owner struct<id: string, team: struct<name: string>>,
            meta map<string, bigint>, tags array<string>, props string, note string"""


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([
        (1, ("u1", ("core",)), {"opened": 1785485066, "link:1": 5}, ["a", None],
         '{"k": 7, "deep": {"x": "y"}, "at": 1785485066000}', "plain"),
        (2, (None, None), None, None, "not json", None),
        (3, None, {}, [], None, "é"),
    ], NESTED)


def by_id(df):
    return {row.id: row for row in df.collect()}


def test_nested_values_become_json_text_that_keeps_nulls(records):
    rows = by_id(flatten_json(records))
    assert json.loads(rows[1].owner) == {"id": "u1", "team": {"name": "core"}}
    assert json.loads(rows[2].owner) == {"id": None, "team": None}
    assert json.loads(rows[1].tags) == ["a", None]
    assert json.loads(rows[1].meta) == {"opened": 1785485066, "link:1": 5}
    assert rows[3].owner is None and rows[3].tags == "[]" and rows[1].note == "plain"


def test_promotion_gives_null_at_any_missing_step(records):
    rows = by_id(promote_fields(records, {
        "owner.id": "owner_id", "owner.team.name": "team", "owner.nope.x": "none",
        "nothing.at.all": "nothing", "meta.opened": "opened", "props.k": "k",
        "props.deep": "deep", "note.inside": "inside", "id.inside": "scalar", "owner": "copy",
    }))
    first = rows[1]
    assert (first.owner_id, first.team, first.none, first.nothing) == ("u1", "core", None, None)
    assert (first.opened, first.k, first.inside, first.scalar) == (1785485066, "7", None, None)
    assert json.loads(first.deep) == {"x": "y"}
    assert json.loads(first["copy"])["id"] == "u1" and first.owner.id == "u1"
    assert rows[2].team is None and rows[2].k is None and rows[3].owner_id is None


def test_promotion_overwrites_a_column_of_the_same_name(records):
    df = promote_fields(records, {"owner.id": "note"})
    assert by_id(df)[1].note == "u1" and df.columns == records.columns


def test_promoted_values_are_parsed_only_where_hinted(records):
    resource = Resource("r", ("id",), hint_columns=("opened_at", "seen_at"), promote={
        "meta.opened": "opened_at", "props.at": "seen_at", "props.k": "k"})
    rows = by_id(records.filter("id <> 2").transform(shape(resource)))
    assert rows[1].opened_at == rows[1].seen_at == INSTANT and rows[1].k == "7"
    assert rows[3].opened_at is None


def test_excluded_fields_cannot_be_promoted_from(records):
    resource = Resource("r", ("id",), promote={"owner.id": "owner_id"}, html_text={"note": "text"},
                        exclude_columns=("owner", "note"))
    df = records.transform(shape(resource))
    assert "owner" not in df.columns and "note" not in df.columns
    assert by_id(df)[1].owner_id is None and by_id(df)[1].text is None


def test_the_whole_chain(spark):
    records = spark.createDataFrame(
        [("w1", {"id": "o1"}, ({"nested": True},), "2026-07-31T08:04:26Z", "secret", "<b>x</b>"),
         ("w2", None, None, None, "secret", "")],
        "id string, owner map<string,string>, meta struct<flags: map<string,boolean>>, "
        "createdAt string, internalNotes string, body string",
    )
    resource = Resource(
        "widgets", ("id",), soft_delete="always", timestamp_columns=("createdAt",),
        hint_columns=("createdAt",), promote={"owner.id": "ownerId"},
        html_text={"body": "bodyText"}, exclude_columns=("internalNotes",),
    )
    df = landed_rows(records, resource, "L1")
    assert df.columns == ["id", "owner", "meta", "created_at", "body", "owner_id", "body_text",
                          "_deleted", "_load_id"]
    first, second = sorted(df.collect())
    assert (first.created_at, first.owner_id, first.body_text) == (INSTANT, "o1", "x")
    assert (first._deleted, first._load_id) == (False, "L1")
    assert json.loads(first.meta) == {"flags": {"nested": True}}
    assert (second.created_at, second.owner_id, second.body_text) == (None, None, None)


def test_the_tombstone_flag_keeps_what_the_source_sent(spark):
    records = spark.createDataFrame(
        [(1, True), (2, False), (3, None)], "id bigint, _deleted boolean")
    flags = [r._deleted for r in sorted(
        records.transform(shape(Resource("r", ("id",), soft_delete="always"))).collect())]
    assert flags == [True, False, False]
    plain = records.drop("_deleted").transform(shape(Resource("r", ("id",))))
    assert plain.columns == ["id"]


def test_an_open_map_stays_one_column(records):
    df = contain_open_map(records, "meta", {"opened": "opened_at", "bounced": "bounced_at"})
    assert [c for c in df.columns if "link" in c] == []
    row = by_id(df)[1]
    assert "link:1" in row.meta and row.opened_at == 1785485066 and row.bounced_at is None


def test_sampling_is_by_key(spark):
    rows = spark.range(100).repartition(7)
    assert [r.id for r in sample_landed(rows, ("id",), 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("name, landed", [
    ("updatedAt", "updated_at"), ("regionHead", "region_head"), ("id", "id"),
    ("_deleted", "_deleted"), ("_dealUpdatedAt", "_deal_updated_at"),
    ("HTTPStatus", "http_status"), ("postingID", "posting_id"), ("already_snake", "already_snake"),
    ("with space", "with_space"), ("totalPrice2Pay", "total_price2_pay"),
])
def test_landed_names(name, landed):
    assert snake_case(name) == landed


def test_two_columns_may_not_land_under_one_name(spark):
    df = spark.createDataFrame([(1, 2)], "updatedAt int, updated_at int")
    with pytest.raises(ValueError, match="updated_at"):
        snake_case_columns(df)


@pytest.mark.parametrize("html, text", [
    (None, None), ("", None), ("plain", "plain"),
    ("<p>Hi <b>there</b></p>", "Hi there"),
    ("a &amp; b &lt;c&gt; &eacute; &#39;q&#x27; &nosuch; AT&T", "a & b <c> é 'q' &nosuch AT&T"),
    ("<script>var a='</p>';</script>x<style>p{}</style>y", "xy"),
    ("<!DOCTYPE html><!-- no --><template>no<b>no</b></template>yes", "yes"),
    ("<div><template>no</div>yes", "yes"),
    ("<ruby>k<rt>no</rt></ruby>", "k"),
    ("  lead and trail  ", "  lead and trail  "),
    ("<p>a</p>  \n <p>b</p>   <p>c</p>", "a\nb c"),
    ("<pre>  \n </pre>", "  \n "),
    ("<![CDATA[kept]]>", "kept"),
    ("a<br>b<br/>c<img src=x>d", "abcd"),
    ("<p>unclosed <b>tags", "unclosed tags"),
    ("</p>stray", "stray"),
])
def test_text_of_html(html, text):
    assert html_text(html) == text


def test_html_is_stripped_in_a_column(spark):
    df = spark.createDataFrame([(1, "<p>a</p>"), (2, None)], "id int, h string")
    assert [r[0] for r in df.orderBy("id").select(strip_html(F.col("h"))).collect()] == ["a", None]


def test_observed_text_is_cut_at_the_limit(spark):
    df = spark.createDataFrame([("x" * 900,), ("x" * 500,), (None,)], "t string")
    cut, whole, none = [r[0] for r in df.select(truncate_observed(F.col("t"))).collect()]
    assert len(cut) == 500 and cut.endswith("…") and whole == "x" * 500 and none is None


@pytest.mark.parametrize("url, path", [
    ("https://h.example/v1/a?x=/b#/c", "/v1/a"), ("https://h.example", ""),
    ("https://h.example?x=1", ""), ("/v1/a/", "/v1/a/"), ("//h.example/a", "/a"),
    ("https://h.example/a;x/b;y=1", "/a;x/b"),
])
def test_url_paths(spark, url, path):
    assert spark.range(1).select(url_path(F.lit(url))).first()[0] == path
