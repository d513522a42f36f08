"""Merging, fetching, tombstones, logs and requests on tiny frames, and the
invariants a landing layer stands on."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.contract import Contract
from landfall.operators import incremental as I
from landfall.operators.merge import (
    dedup_latest,
    evolve_add_columns,
    merge_upsert,
    supports_merge_into,
)
from landfall.operators.requests import request_family, requests_by_family, routes_of
from landfall.operators.runlog import (
    failures_for_asset,
    first_failure,
    latest_verdict,
    observed_schema,
    record_run,
    rows_this_run,
    run_summary,
    schema_changes,
    schema_rows,
    table_counts,
)
from landfall.operators.tombstone import absent_keys, mark_deleted, mark_deleted_counts

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


def bag(df, *columns):
    return sorted(
        (tuple(row) for row in (df.select(*columns) if columns else df).collect()), key=repr
    )


def test_the_newest_wins_and_ties_break_by_the_other_columns(spark):
    rows = spark.createDataFrame([
        (1, "b", at(2)), (1, "a", at(2)), (1, "z", at(1)), (2, "x", None), (2, "y", at(0)),
        (None, "n", at(0)), (None, "m", at(1)),
    ], "id bigint, v string, at timestamp")
    for shuffled in (rows, rows.orderBy(F.desc("v")), rows.repartition(5)):
        assert bag(dedup_latest(shuffled, ["id"], "at"), "id", "v") == [
            (1, "a"), (2, "y"), (None, "m"), (None, "n")]


def test_merging_twice_is_merging_once_without_keys_too(spark):
    target = spark.createDataFrame([(1, "a"), (None, "old"), (2, "b")], "id bigint, v string")
    delta = spark.createDataFrame([(None, "x"), (None, "y"), (2, "B")], "id bigint, v string")
    once = merge_upsert(target, delta, ["id"])
    assert bag(once) == bag(merge_upsert(once, delta, ["id"])) == [
        (1, "a"), (2, "B"), (None, "x"), (None, "y")]


def test_merge_adds_columns_from_either_side(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id bigint, v string, old int")
    delta = spark.createDataFrame([(2, "B", True), (3, "C", False)],
                                  "id bigint, v string, new boolean")
    assert bag(merge_upsert(target, delta, ["id"])) == [
        (1, "a", 1, None), (2, "B", None, True), (3, "C", None, False)]


def test_columns_are_added_with_their_default(spark):
    rows = spark.createDataFrame([(1, "warn"), (2, None)], "id int, severity string")
    evolved = evolve_add_columns(
        rows, {"severity": ("string", "error"), "note": ("string", None), "n": ("int", 0)})
    assert bag(evolved) == [(1, "warn", None, 0), (2, "error", None, 0)]
    assert evolve_add_columns(rows, {}) is rows


def test_plain_files_do_not_take_merge_into(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE plain_files USING parquet LOCATION '{tmp_path / 't'}'")
    assert supports_merge_into(spark, "plain_files") is False
    spark.sql("DROP TABLE plain_files")


deltas = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abc"), st.integers(0, 3)),
                  max_size=12)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deltas, deltas)
def test_merge_is_idempotent_and_complete(spark, before, fetched):
    schema = "id bigint, v string, n int"
    target = dedup_latest(spark.createDataFrame(before, schema), ["id"], "n")
    delta = spark.createDataFrame(fetched, schema)
    once = merge_upsert(target, delta, ["id"], "n")
    assert bag(merge_upsert(once, delta, ["id"], "n")) == bag(once)
    ids = [row[0] for row in once.select("id").collect()]
    assert sorted(ids) == sorted({r[0] for r in before} | {r[0] for r in fetched})
    newest = {i: max(n for j, _, n in fetched if j == i) for i, _, _ in fetched}
    assert all(row.n == newest[row.id] for row in once.collect() if row.id in newest)
    assert absent_keys(delta, delta, ["id"]).isEmpty()


def test_the_lower_bound_is_inclusive_and_needs_a_cursor(spark):
    rows = spark.createDataFrame([(1, at(0)), (2, at(1)), (3, at(2)), (4, None)],
                                 "id int, at timestamp")

    def ids(df):
        return [row.id for row in sorted(df.collect())]

    assert ids(I.search_window(rows, "at", at(1))) == [2, 3, 4]
    assert ids(I.search_window(rows, "at", at(2), 3600)) == [2, 3, 4]
    assert ids(I.search_window(rows, "at", None)) == [1, 2, 3, 4]
    assert ids(I.search_window(rows, "at", None, initial_value=at(2))) == [3, 4]
    assert ids(I.search_window(rows, "at", at(1), initial_value=at(2))) == [2, 3, 4]
    assert ids(I.admit_since(rows, "at", at(1), "exclude")) == [2, 3]
    assert ids(I.admit_since(rows, "at", None, "exclude")) == [1, 2, 3]
    with pytest.raises(PySparkException, match="a row has no at"):
        I.admit_since(rows, "at", at(1), "raise").collect()
    with pytest.raises(ValueError):
        I.admit_since(rows, "at", at(1), "drop")


def test_a_backfill_is_half_open(spark):
    rows = spark.createDataFrame([(i, at(i)) for i in range(4)], "id int, at timestamp_ntz")
    assert bag(I.backfill_window(rows, "at", at(1), at(3)), "id") == [(1,), (2,)]


def test_fanning_out_needs_parents(spark):
    children = spark.createDataFrame([(1, 10, at(0)), (2, None, at(1)), (3, 11, at(1))],
                                     "id int, parent int, at timestamp")
    parents = spark.createDataFrame([(10,), (10,), (12,)], "pid int")
    assert bag(I.parent_fanout(children, parents, "parent", "pid"), "id") == [(1,)]
    assert bag(I.parent_fanout(children, parents, "parent", "pid", "at", at(1)), "id") == []
    with pytest.raises(RuntimeError, match="no parents"):
        I.parent_fanout(children, parents.filter("pid > 99"), "parent", "pid")


PARENTS = [(1, at(0)), (2, at(5)), (2, at(6)), (3, at(9)), (4, None)]


def test_children_of_changed_parents_are_read_again(spark):
    parents = spark.createDataFrame(PARENTS, "pid int, at timestamp")
    children = spark.createDataFrame([(10, 1), (20, 2), (21, 2), (40, 4), (50, None)],
                                     "id int, parent int")
    worklist = I.changed_parents(parents, "pid", "at", at(6), lookback_seconds=3600)
    assert bag(worklist) == [(2, at(6)), (3, at(9))]
    rows = I.parent_watermark(children, worklist, "parent", "pid", "at", "_at")
    assert bag(rows, "id", "parent", "_at") == [(20, 2, at(6)), (21, 2, at(6))]
    first = I.changed_parents(parents, "pid", "at", None)
    assert bag(first, "pid") == [(1,), (2,), (3,), (4,)]
    assert I.advance_watermark(worklist, "at", at(6)).first()[0] == at(9)


@pytest.mark.parametrize("rows, old, new", [
    (PARENTS, None, at(9)), (PARENTS, at(20), at(20)), ([], at(3), at(3)),
    ([(1, None)], None, datetime(1970, 1, 1)), ([], None, datetime(1970, 1, 1)),
])
def test_the_watermark_never_falls(spark, rows, old, new):
    worklist = spark.createDataFrame(rows, "pid int, at timestamp")
    assert I.advance_watermark(worklist, "at", old).first()[0] == new


def test_a_watermark_at_the_epoch_bounds_nothing(spark):
    parents = spark.createDataFrame(PARENTS, "pid int, at timestamp")
    worklist = I.changed_parents(parents, "pid", "at", datetime(1970, 1, 1), 300)
    assert worklist.count() == 4


LANDED = "id int, _deleted boolean, _load_id string"


def test_only_live_rows_of_other_loads_are_marked(spark):
    rows = spark.createDataFrame(
        [(1, False, "L1"), (2, False, "L0"), (3, True, "L0"), (4, False, None), (5, None, "L0")],
        LANDED,
    )
    assert bag(mark_deleted(rows, ["L1", "L2"]), "id", "_deleted") == [
        (1, False), (2, True), (3, True), (4, False), (5, None)]
    assert mark_deleted(rows, []) is rows
    counts = mark_deleted_counts(spark, {"t": rows, "never": None}, ["L1"])
    assert bag(counts) == [("never", 0), ("t", 1)]
    assert mark_deleted_counts(spark, {"t": rows}, []).count() == 0


LOG = "validated_at timestamp, asset string, expectation string, column_name string, " \
      "description string, success boolean"


def verdicts(spark, *entries):
    return spark.createDataFrame([(at(h), a, "e", None, d, ok) for h, a, d, ok in entries], LOG)


def test_questions_the_verdict_log_answers(spark):
    log = verdicts(
        spark, (0, "t", "x", True), (1, "t", "x", False), (2, "t", "x", False),
        (30, "t", "x", True), (60, "t", "x", False), (0, "t", "y", False), (1, "t", "y", True),
        (5, "u", "x", False),
    )
    assert bag(latest_verdict(log), "asset", "description", "success") == [
        ("t", "x", False), ("t", "y", True), ("u", "x", False)]
    failed = failures_for_asset(log, "t").select("validated_at").collect()
    assert [row[0] for row in failed] == [at(60), at(2), at(1), at(0)]
    for unit in ("hour", "day", "year"):
        edges = bag(first_failure(log, slice_unit=unit), "validated_at", "description")
        assert edges == [(at(1), "x"), (at(60), "x")]


checks = st.lists(st.tuples(st.integers(0, 80), st.sampled_from("ab"), st.booleans()),
                  unique_by=lambda e: e[:2], max_size=25)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(checks, st.sampled_from(["hour", "day"]))
def test_edges_agree_with_brute_force(spark, entries, unit):
    log = verdicts(spark, *[(h, "t", name, ok) for h, name, ok in entries])
    expected = []
    for name in "ab":
        mine = sorted((h, ok) for h, n, ok in entries if n == name)
        expected += [
            (name, at(h)) for (_, before), (h, ok) in zip(mine, mine[1:]) if before and not ok
        ]
    assert bag(first_failure(log, slice_unit=unit), "description", "validated_at") == sorted(
        expected, key=repr)


def test_counts_and_summary(spark):
    rows = spark.createDataFrame([(1, False, "L1"), (2, False, "L0")], LANDED)
    counts = table_counts(spark, {"t": rows, "never": None, "_ledger": rows})
    landed = rows_this_run(spark, {"t": rows, "never": None}, ["L1", "L2"])
    assert bag(counts) == [("_ledger", 2), ("never", None), ("t", 2)]
    assert bag(landed) == [("t", 1)]
    assert [tuple(r) for r in run_summary(counts, landed).collect()] == [
        ("never", 0, None), ("t", 1, 2)]
    assert rows_this_run(spark, {"t": rows}, []).count() == 0


def test_a_run_is_recorded_even_with_a_bad_start_time(spark):
    runs = spark.createDataFrame(
        [("soon", ["a"], {"a": 1}), ("2024-01-01T00:00:00+00:00", None, None)],
        "started_at string, resources array<string>, rows_this_run map<string,bigint>",
    )
    rows = record_run(runs).collect()
    assert [r.started_at for r in rows] == [None, T0]
    assert [r.resources for r in rows] == ['["a"]', "[]"]
    assert [r.rows_this_run for r in rows] == ['{"a":1}', "{}"]
    assert rows[0].requests_by_family == "{}" and rows[0].dag_id is None


def test_schema_changes_are_new_columns_tables_and_types(spark):
    old = spark.createDataFrame([], "id int, v string")
    new = spark.createDataFrame([], "id bigint, v string, extra double")
    changes = schema_changes(schema_rows(spark, {"t": new, "u": old}),
                             schema_rows(spark, {"t": old}))
    assert bag(changes) == [("t", "extra", "double"), ("t", "id", "bigint"),
                            ("u", "id", "int"), ("u", "v", "string")]


def test_a_schema_is_what_records_show(spark):
    records = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": "x", "c": [1]}',)], "j string")
    seen = observed_schema(records.select(F.parse_json("j").alias("record")), "t")
    assert bag(seen, "column_name", "data_type") == [
        ("a", "BIGINT"), ("a", "STRING"), ("c", "ARRAY<BIGINT>")]


def test_the_longest_declared_route_wins(spark):
    contract = Contract.from_dict({
        "name": "s", "api": {"base_url": "b", "auth": {"type": "t", "token_env": "e"}},
        "resources": [
            {"name": "notes", "primary_key": "id", "endpoint": {"path": "/v1/a/notes"}},
            {"name": "a", "primary_key": "id", "endpoint": {"path": "/v1/a", "family": "core"}},
            {"name": "plain", "primary_key": "id"},
        ],
    })
    routes = routes_of(contract)
    urls = ["https://h/v1/a/notes?x=1", "https://h/v1/a/7", "https://h/plain/", "https://h/v2",
            "https://h/v2?next=/v1/a"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    families = [r[0] for r in df.select(request_family(F.col("url"), routes)).collect()]
    assert families == ["notes", "core", "plain", "unmatched", "unmatched"]
    assert dict(bag(requests_by_family(df, "url", routes)))["unmatched"] == 2
    assert df.select(request_family(F.col("url"), {})).distinct().first()[0] == "unmatched"
