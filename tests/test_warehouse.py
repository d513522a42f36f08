"""Landing: staged, switched and committed; replayed after a crash; tombstoned."""

from datetime import date, datetime

import pytest

from landfall.operators.merge import least_type, merge_upsert
from landfall.operators.shape import LOAD_ID
from landfall.plans.warehouse import Warehouse

SCHEMA = f"id bigint, v string, _deleted boolean, {LOAD_ID} string"


@pytest.fixture
def warehouse(tmp_path):
    return Warehouse(str(tmp_path), "probe", buckets=4)


def load(spark, rows, load_id):
    return spark.createDataFrame([(i, v, False, load_id) for i, v in rows], SCHEMA)


def content(warehouse, spark, table="t"):
    rows = warehouse.read(spark, table)
    return sorted(tuple(row) for row in rows.select("id", "v", "_deleted").collect())


def test_merge_replaces_on_key_and_keeps_the_rest(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a"), (2, "b")], "L1"), ["id"], "L1")
    warehouse.land("t", load(spark, [(2, "B"), (3, "c")], "L2"), ["id"], "L2")
    assert content(warehouse, spark) == [(1, "a", False), (2, "B", False), (3, "c", False)]


def test_merging_twice_is_merging_once(spark, warehouse):
    for load_id in ("L1", "L2"):
        warehouse.land("t", load(spark, [(1, "a"), (2, "b")], load_id), ["id"], load_id)
    assert content(warehouse, spark) == [(1, "a", False), (2, "b", False)]


def test_a_committed_load_does_not_land_again(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a")], "L1"), ["id"], "L1")
    warehouse.land("t", load(spark, [(1, "changed")], "L1"), ["id"], "L1")
    assert content(warehouse, spark) == [(1, "a", False)]


def test_an_empty_load_changes_nothing(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a")], "L1"), ["id"], "L1")
    warehouse.land("t", load(spark, [], "L2"), ["id"], "L2")
    assert content(warehouse, spark) == [(1, "a", False)]


def test_a_prepared_load_is_finished_first(spark, warehouse, monkeypatch):
    warehouse.land("t", load(spark, [(1, "a")], "L1"), ["id"], "L1")

    def crash(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(Warehouse, "_switch", crash)
    with pytest.raises(RuntimeError):
        warehouse.land("t", load(spark, [(1, "A"), (2, "b")], "L2"), ["id"], "L2")
    monkeypatch.undo()
    assert content(warehouse, spark) == [(1, "a", False)]
    assert warehouse.recover(spark) == [("t", "L2")]
    assert content(warehouse, spark) == [(1, "A", False), (2, "b", False)]
    assert warehouse.recover(spark) == []


def test_new_columns_are_null_on_older_rows(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a"), (5, "e"), (6, "f")], "L1"), ["id"], "L1")
    wider = spark.createDataFrame(
        [(2, "b", False, "L2", 7)], SCHEMA + ", extra bigint"
    )
    warehouse.land("t", wider, ["id"], "L2")
    rows = {row.id: row.extra for row in warehouse.read(spark, "t").collect()}
    assert rows == {1: None, 2: 7, 5: None, 6: None}


def test_replace_keeps_only_this_load_and_append_keeps_all(spark, warehouse):
    for load_id, row in (("L1", (1, "a")), ("L2", (2, "b"))):
        warehouse.land("r", load(spark, [row], load_id), ["id"], load_id, "replace")
        warehouse.land("p", load(spark, [row], load_id), ["id"], load_id, "append")
    assert content(warehouse, spark, "r") == [(2, "b", False)]
    assert content(warehouse, spark, "p") == [(1, "a", False), (2, "b", False)]


def test_absent_rows_are_tombstoned_and_revived(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a"), (2, "b")], "L1"), ["id"], "L1")
    warehouse.land("t", load(spark, [(1, "a")], "L2"), ["id"], "L2")
    assert warehouse.mark_deleted(spark, ["t", "never"], ["L2"]) == {"t": 1, "never": 0}
    assert content(warehouse, spark) == [(1, "a", False), (2, "b", True)]
    assert warehouse.mark_deleted(spark, ["t"], ["L2"]) == {"t": 0}
    warehouse.land("t", load(spark, [(2, "b")], "L3"), ["id"], "L3")
    assert content(warehouse, spark) == [(1, "a", False), (2, "b", False)]
    assert warehouse.mark_deleted(spark, ["t"], []) == {}


@pytest.mark.parametrize("disposition, marked", [("append", 1), ("replace", 0)])
def test_tables_that_are_not_merged_can_be_tombstoned_too(
    spark, warehouse, disposition, marked
):
    for load_id, row in (("L1", (1, "a")), ("L2", (2, "b"))):
        warehouse.land("t", load(spark, [row], load_id), ["id"], load_id, disposition)
    assert warehouse.mark_deleted(spark, ["t"], ["L2"]) == {"t": marked}
    kept = {"append": [(1, "a", True), (2, "b", False)], "replace": [(2, "b", False)]}
    assert content(warehouse, spark) == kept[disposition]
    warehouse.publish(spark, ["t"])
    assert spark.table("raw_probe.t").count() == len(kept[disposition])
    spark.sql("DROP DATABASE raw_probe CASCADE")
    with pytest.raises(ValueError, match=f"a table of {disposition} loads"):
        warehouse.land("t", load(spark, [], "L3"), ["id"], "L3", "merge")


def test_cursors_are_kept_per_resource_and_destination(spark, warehouse, tmp_path):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    warehouse.save_cursor(spark, "t", late, "L2", late)
    warehouse.save_cursor(spark, "t", early, "L1", early)
    assert warehouse.cursor(spark, "t") == late
    assert warehouse.cursor(spark, "u") is None
    rehearsal = Warehouse(str(tmp_path), "probe", 4, destination="trial")
    assert rehearsal.cursor(spark, "t") is None
    rehearsal.save_cursor(spark, "t", datetime(2030, 1, 1), "X", late)
    assert warehouse.cursor(spark, "t") == late


def test_published_tables_can_be_queried(spark, warehouse):
    warehouse.land("t", load(spark, [(1, "a"), (2, "b")], "L1"), ["id"], "L1")
    warehouse.publish(spark, ["t", "never"])
    assert spark.sql("SELECT count(*) FROM raw_probe.t").first()[0] == 2
    warehouse.land("t", load(spark, [(3, "c")], "L2"), ["id"], "L2")
    warehouse.publish(spark, ["t"])
    assert spark.table("raw_probe.t").count() == 3
    spark.sql("DROP DATABASE raw_probe CASCADE")


def test_a_column_keeps_its_type_and_another_lands_beside_it(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)
    for load, (kind, value) in enumerate(
            [("bigint", 1), ("double", 1.5), ("string", "abc"), ("int", 7), ("double", 2.5)]):
        rows = spark.createDataFrame([(load, value)], f"id bigint, v {kind}")
        warehouse.land("t", rows, ["id"], f"L{load}")
    got = {r.id: (r.v, r.v__v_double, r.v__v_string) for r in warehouse.read(spark, "t").collect()}
    assert got == {0: (1, None, None), 1: (None, 1.5, None), 2: (None, None, "abc"),
                   3: (7, None, None), 4: (None, 2.5, None)}


KINDS = {
    ("tinyint", "bigint"): "bigint", ("bigint", "tinyint"): "bigint", ("int", "double"): "double",
    ("double", "bigint"): "double", ("float", "double"): "double", ("double", "float"): "double",
    ("float", "int"): "double", ("bigint", "double"): None, ("decimal(10,2)", "decimal(6,4)"): "decimal(12,4)",
    ("decimal(38,2)", "decimal(38,4)"): None, ("decimal(4,1)", "bigint"): "decimal(21,1)",
    ("bigint", "decimal(6,2)"): "decimal(22,2)", ("decimal(5,1)", "double"): None, ("double", "decimal(5,1)"): None,
    ("string", "double"): "string", ("string", "boolean"): "string", ("string", "timestamp"): "string",
    ("double", "string"): None, ("boolean", "bigint"): None, ("bigint", "boolean"): None, ("timestamp", "date"): "timestamp",
    ("date", "timestamp"): None, ("string", "binary"): None, ("int", "void"): "int",
}


@pytest.mark.parametrize("kinds", KINDS, ids=" ".join)
def test_the_least_type_of_two(spark, kinds):
    known, new = (spark.sql(f"SELECT CAST(NULL AS {kind}) v").schema["v"].dataType if kind != "void"
                  else spark.sql("SELECT NULL v").schema["v"].dataType for kind in kinds)
    found = least_type(known, new)
    assert (found and found.simpleString()) == KINDS[kinds]


def test_types_drift_both_ways_and_no_value_is_stranded(spark, tmp_path):
    """Every bucket is read in the widened type, those written before it too."""
    warehouse = Warehouse(str(tmp_path), "s", buckets=4)

    def land(load, rows, kind):
        warehouse.land("t", spark.createDataFrame(rows, f"id bigint, v {kind}"), ["id"], f"L{load}")

    land(0, [(i, i) for i in range(40)], "int")
    land(1, [(0, 1 << 40)], "bigint")
    land(2, [(1, 5)], "smallint")
    got = {r.id: r.v for r in warehouse.read(spark, "t").collect()}
    assert got == {**{i: i for i in range(40)}, 0: 1 << 40, 1: 5}
    assert warehouse.schema(spark, "t")["v"].dataType.simpleString() == "bigint"
    warehouse.publish(spark, ["t"])
    assert spark.table("raw_s.t").agg({"v": "max"}).first()[0] == 1 << 40
    spark.sql("DROP DATABASE raw_s CASCADE")


def test_whole_numbers_in_a_column_of_fractions(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)
    for load, (rows, kind) in enumerate([
            ([(1, 1.5), (2, 2.5), (3, 3.5)], "double"), ([(1, 7), (4, None)], "bigint"),
            ([(2, 2**53 + 1), (5, 2**53), (6, 2**63 - 1)], "bigint")]):
        warehouse.land("t", spark.createDataFrame(rows, f"id bigint, v {kind}"), ["id"], f"L{load}")
    got = {r.id: (r.v, r.v__v_bigint) for r in warehouse.read(spark, "t").collect()}
    assert got == {1: (7.0, None), 2: (None, 2**53 + 1), 3: (3.5, None), 4: (None, None),
                   5: (2.0**53, None), 6: (None, 2**63 - 1)}


def test_anything_plain_in_a_text_column(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)
    for load, (kind, value) in enumerate([
            ("string", "abc"), ("bigint", 12), ("double", 1.5), ("boolean", True), ("date", date(2024, 1, 2))]):
        warehouse.land("t", spark.createDataFrame([(load, value)], f"id bigint, v {kind}"), ["id"], f"L{load}")
    rows = warehouse.read(spark, "t")
    assert rows.columns == ["id", "v"]
    assert [r.v for r in rows.orderBy("id").collect()] == ["abc", "12", "1.5", "true", "2024-01-02"]


def test_an_append_table_widens_too(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)
    for load, (kind, value) in enumerate([("float", 1.5), ("int", 7), ("double", 2.25)]):
        rows = spark.createDataFrame([(load, value, f"L{load}")], f"id bigint, v {kind}, _load_id string")
        warehouse.land("t", rows, ["id"], f"L{load}", "append")
    assert [r.v for r in warehouse.read(spark, "t").orderBy("id").collect()] == [1.5, 7.0, 2.25]


def test_a_lost_load_is_finished_before_a_newer_one(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)

    def row(value):
        return spark.createDataFrame([(1, value)], "id bigint, v string")

    warehouse.land("t", row("first"), ["id"], "L1")
    with monkeypatch.context() as lost:
        lost.setattr(Warehouse, "_switch", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.land("t", row("lost"), ["id"], "L2")
    warehouse.land("t", row("newest"), ["id"], "L3")
    assert warehouse.recover(spark) == []
    assert [r.v for r in warehouse.read(spark, "t").collect()] == ["newest"]


def test_a_load_older_than_the_last_commit_is_given_up(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "s", buckets=2)
    for load in ("L1", "L2"):
        warehouse.land("t", spark.createDataFrame([(1, load)], "id bigint, v string"), ["id"], load)
    warehouse._enter(spark, "t", "L0", "merge", "prepared", 1)
    assert warehouse.recover(spark) == [] and warehouse.recover(spark) == []
    assert [r.v for r in warehouse.read(spark, "t").collect()] == ["L2"]


def test_rows_without_a_key_outlive_other_loads(spark, warehouse):
    warehouse.land("t", load(spark, [(None, str(i)) for i in range(100)] + [(1, "a")], "L1"), ["id"], "L1")
    warehouse.land("t", load(spark, [(None, "new"), (None, "7"), (1, "A")], "L2"), ["id"], "L2")
    warehouse.land("t", load(spark, [(None, "new")], "L2"), ["id"], "L2")
    landed = warehouse.read(spark, "t").select("id", "v", LOAD_ID).collect()
    assert sorted((r.v, r[LOAD_ID]) for r in landed if r.id is None) == sorted(
        [(str(i), "L1") for i in range(100)] + [("new", "L2"), ("7", "L2")])
    assert [(r.v, r[LOAD_ID]) for r in landed if r.id == 1] == [("A", "L2")]


def test_a_load_merged_again_replaces_its_own_rows_without_a_key(spark):
    target = load(spark, [(None, "a"), (None, "b"), (2, "c")], "L1")
    delta = load(spark, [(None, "x"), (None, "x"), (2, "C")], "L2")
    once = merge_upsert(target, delta, ["id"], load_id="L2")
    for merged in (once, merge_upsert(once, delta, ["id"], load_id="L2")):
        assert sorted(r.v for r in merged.collect()) == ["C", "a", "b", "x", "x"]
