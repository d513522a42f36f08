"""Covered stretches of time, and what a load is told by its own write."""

import itertools
import random
from datetime import datetime, timedelta

import pytest

from landfall.contract import Contract, run_window
from landfall.operators.ranges import RANGES_SCHEMA, covered_until, islands
from landfall.plans.load import run_source
from landfall.plans.warehouse import Warehouse

NOW = datetime(2024, 5, 1)
BY = ["resource"]


def day(n):
    return None if n is None else datetime(2024, 1, 1) + timedelta(days=n)


def ranges(spark, rows):
    return spark.createDataFrame(
        [("s", r, "d", day(a), day(b), day(n), "l", NOW) for r, a, b, n in rows], RANGES_SCHEMA)


def test_overlapping_and_touching_ranges_are_one(spark):
    found = islands(ranges(spark, [
        ("a", 0, 2, 1), ("a", 2, 4, None), ("a", 1, 3, 2), ("a", 6, 8, 7), ("a", 7, 7, 7),
        ("b", None, 3, 3), ("b", 2, 5, 4), ("b", 6, None, 9), ("b", 9, 8, 9),
        (None, 1, 2, 1), (None, 3, 4, 3),
    ]), BY)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        ("a", day(0), day(4), day(2), 3), ("a", day(6), day(8), day(7), 2), ("b", None, day(5), day(4), 2),
        (None, day(1), day(2), day(1), 1), (None, day(3), day(4), day(3), 1)], key=repr)
    assert islands(ranges(spark, []), BY).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_equals_marking_every_day(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), a, a + rng.randint(0, 5), a) for a in (rng.randrange(60) for _ in range(25))]
    found = sorted((r.resource, r.range_start, r.range_end) for r in islands(ranges(spark, rows), BY).collect())
    want = []
    for name in "ab":
        mine = sorted((a, b) for r, a, b, _ in rows if r == name)
        merged = []
        for a, b in mine:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want += [(name, day(a), day(b)) for a, b in merged]
    assert found == want


def test_only_what_reaches_the_floor_is_known(spark):
    told = covered_until(ranges(spark, [("a", 0, 2, 1), ("a", 2, 5, 4), ("a", 7, 9, 8), ("b", 3, 4, 4)]), BY, day(1))
    assert {r.resource: r.newest for r in told.collect()} == {"a": day(4), "b": day(1)}


SOURCE = Contract.from_dict({
    "name": "desk", "api": {"base_url": "https://x.invalid", "auth": {"type": "bearer", "token_env": "T"}},
    "orchestration": {"backfill_start": "2024-01-01"},
    "resources": [{"name": "deals", "primary_key": "id",
                   "incremental": {"strategy": "search_window", "cursor_field": "at"}}]})


def go(spark, warehouse, run_id, window, started=NOW):
    deals = spark.createDataFrame([(i, day(i)) for i in range(60)] + [(99, None)], "id int, at timestamp")
    return run_source(spark, SOURCE, warehouse, {"deals": deals}, window, run_id, started)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))), ids=str)
def test_windows_in_any_order_give_one_cursor(spark, tmp_path, order):
    warehouse = Warehouse(str(tmp_path), "desk", buckets=2)
    seen = []
    for i, k in enumerate(order):
        window = run_window(NOW, start=day(10 * k), end=day(10 * k + 10))
        go(spark, warehouse, f"w{k}", window, NOW + timedelta(hours=i))
        seen.append(warehouse.cursor(spark, "deals"))
    assert seen[-1] == day(29)
    # No cursor runs ahead of a gap: only windows from the first on without one count.
    for upto in (1, 2):
        whole = next(k for k in range(4) if k not in order[:upto])
        assert seen[upto - 1] == (day(10 * whole - 1) if whole else None)
    go(spark, warehouse, "later", run_window(NOW), NOW + timedelta(hours=9))
    assert warehouse.cursor(spark, "deals") == day(59)
    assert warehouse.read(spark, "deals").count() == 31 + 31 - 1


def test_an_empty_window_closes_a_gap(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "desk", buckets=2)
    for name, start, end in (("a", 0, 30), ("c", 61, 100), ("b", 58, 62), ("d", 30, 58)):
        go(spark, warehouse, name, run_window(NOW, start=day(start), end=day(end)))
    assert warehouse.cursor(spark, "deals") == day(59)


def test_the_write_tells_what_it_wrote(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path), "desk", buckets=2)
    rows = spark.createDataFrame([(1, day(1)), (2, day(5)), (2, day(3)), (None, None)], "id int, at timestamp")
    told = {}
    warehouse.land("t", rows, ["id"], "L1", cursor="at", told=told)
    assert told == {"rows": 3, "newest": day(5), "keyless": 1}
    again = {}
    warehouse.land("t", rows, ["id"], "L1", cursor="at", told=again)
    assert again == told
    nothing = {}
    warehouse.land("t", rows.limit(0), ["id"], "L2", cursor="at", told=nothing)
    assert nothing == {"rows": 0, "newest": None, "keyless": 0} and warehouse.read(spark, "t").count() == 3
    plain = {}
    warehouse.land("u", rows.selectExpr("*", "'L1' AS _load_id"), ["id"], "L1", "append", told=plain)
    assert plain == {"rows": 4, "newest": None, "keyless": 1}


def test_a_load_reads_its_delta_once(spark, tmp_path, monkeypatch):
    """The records are scanned by the staging write alone; rows and cursor come out of it.
    (Keys that may be null cost a second pass: rows without one are looked for apart.)"""
    (tmp_path / "in").mkdir()
    source = str(tmp_path / "in" / "deals")
    spark.createDataFrame([(i, day(i)) for i in range(50)], "id int, at timestamp").write.parquet(source)
    warehouse = Warehouse(str(tmp_path / "wh"), "desk", buckets=2)
    counter = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    deals = spark.read.parquet(source).mapInArrow(seen, "id int NOT NULL, at timestamp")
    summary = run_source(spark, SOURCE, warehouse, {"deals": deals}, run_window(NOW), "r1", NOW)
    assert summary["rows_this_run"] == {"deals": 50} and counter.value == 50
    assert warehouse.cursor(spark, "deals") == day(49)
