"""Chains followed from their first page, and pages landed by contract alone."""

import json
import random
from datetime import datetime, timedelta

import pytest

from landfall.contract import Contract, ContractError, Resource, run_window
from landfall.operators.tombstone import soft_delete_eligible
from landfall.plans.load import run_source
from landfall.plans.warehouse import Warehouse
from landfall.sources.chains import chain_breaks, reached_pages
from landfall.sources.envelope import chain_complete
from landfall.sources.landed import (
    PAGES, chains_complete, paging_of, read_pages, records_from_pages,
)

CURSOR = "resource string, cursor_in string, next string, items int"
NOW = datetime(2024, 5, 1)
API = {"base_url": "https://x.invalid", "auth": {"type": "bearer", "token_env": "T"}}


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_detached_loop_of_pages_is_past_the_end(spark):
    df = spark.createDataFrame([
        ("looped", None, "p2", 3), ("looped", "p2", "", 1), ("looped", "p5", "p6", 2), ("looped", "p6", "p5", 2),
        ("whole", None, "p2", 1), ("whole", "p2", None, 1),
        ("back", None, "p2", 1), ("back", "p2", "p2", 1),
        ("lost", None, "p2", 2), ("lost", "p3", "p4", 1), ("lost", "p4", "", 1),
        ("headless", "p2", "", 1),
        ("beyond", None, "p2", 0), ("beyond", "p2", None, 3),
        (None, None, "p2", 1), (None, "p2", "", 1),
    ], CURSOR)
    breaks = chain_breaks(df)
    assert bag(breaks) == [
        ("beyond", "p2", "past_end"), ("headless", "p2", "past_end"), ("looped", "p5", "past_end"),
        ("looped", "p6", "past_end"), ("lost", "p2", "dangling_next"), ("lost", "p3", "past_end"),
        ("lost", "p4", "past_end")]
    complete = dict(map(tuple, chain_complete(df.filter("resource IS NOT NULL"), breaks).collect()))
    assert complete == {"looped": False, "whole": True, "back": True, "lost": False, "headless": False,
                        "beyond": False}
    assert bag(chain_breaks(df.limit(0))) == []


@pytest.mark.parametrize("seed", range(3))
def test_equals_following_page_by_page(spark, seed):
    rng = random.Random(seed)
    rows = []
    for chain in range(4):
        size = rng.choice([1, 3, 17, 40])
        for page in range(size):
            ahead = page + 1 if rng.random() < 0.9 else rng.randrange(size + 2)
            rows.append((f"r{chain % 2}", f"parent{chain}" if chain else None, f"t{page}" if page else None,
                         rng.choice([f"t{ahead}"] * 8 + ["", None]), rng.choice([1] * 9 + [0])))
    rows += rows[:6]  # pages that landed twice
    found = {}
    for r, parent, at, ahead, items in rows:
        if items and ahead:
            found.setdefault((r, parent, at), set()).add(ahead)
    landed = {(r, p, at) for r, p, at, _, _ in rows}
    reached, todo = set(), [x for x in landed if x[2] is None]
    while todo:
        here = todo.pop()
        if here in reached or here not in landed:
            continue
        reached.add(here)
        todo += [(*here[:2], t) for t in found.get(here, ())]
    want = {(*x, "past_end") for x in landed - reached}
    want |= {(*x[:2], t, "dangling_next") for x in reached for t in found.get(x, ())
             if (*x[:2], t) not in landed}
    df = spark.createDataFrame(rows, "resource string, parent string, cursor_in string, next string, items int")
    assert bag(chain_breaks(df, ["resource", "parent"])) == sorted(want, key=repr)


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    from landfall.sources import chains

    rounds, kept = [], chains._kept
    monkeypatch.setattr(chains, "_kept", lambda df: rounds.append(1) or kept(df))
    size = 300
    df = spark.createDataFrame(
        [("r", f"t{i}" if i else None, f"t{i + 1}" if i + 1 < size else "", 1) for i in range(size)], CURSOR)
    reached = reached_pages(df, ["resource"])
    assert reached.count() == size and len(rounds) <= 2 * 11
    assert "Window" not in reached._jdf.queryExecution().executedPlan().toString()


def contract(kind, selector="data", **resource):
    return Contract.from_dict({
        "name": "desk", "api": API, "orchestration": {"backfill_start": "2020-01-01"},
        "pagination": {"kind": kind, "cursor_path": "next", "data_selector": selector, "total_path": "meta.pages"},
        "resources": [{"name": "notes", "primary_key": "id", "soft_delete": "always", **resource}]})


def cursor_pages(*pages):
    """(cursor_in, next, records) of a chain of notes."""
    return [("notes", None, None, at, json.dumps({"data": records, "next": ahead})) for at, ahead, records in pages]


def test_records_have_the_widest_types_seen(spark):
    pages = spark.createDataFrame(cursor_pages(
        (None, "b", [{"id": 1, "v": 1, "open": {"a": [1, None]}, "when": "2024-01-01T00:00:00Z"}]),
        ("b", "", [{"id": 2, "v": 1.5, "open": {"a": "x"}, "more": True}, {"id": 3, "v": None, "or": 1}, {"id": 4, "or": "y"}])),
        PAGES)
    rows = records_from_pages(pages, contract("cursor"), contract("cursor").resource("notes"))
    kinds = {name: kind for name, kind in rows.dtypes}
    assert kinds["id"] == "bigint" and kinds["more"] == "boolean" and kinds["open"] == kinds["or"] == "variant"
    assert sorted(float(r.v) for r in rows.collect() if r.v is not None) == [1.0, 1.5]
    asked = contract("cursor", endpoint={"params": {"fields": "id, v,gone"}})
    named = records_from_pages(pages, asked, asked.resource("notes"))
    assert named.columns == ["id", "v", "gone"] and named.count() == 4


def test_one_contract_from_pages_to_table(spark, tmp_path):
    """The chain decides what may be tombstoned: a gap licenses nothing, a whole chain does."""
    told = contract("cursor", timestamp_columns=["at"])
    warehouse = Warehouse(str(tmp_path), told.name, buckets=2)

    def run(day, pages, **more):
        at = NOW + timedelta(days=day)
        return run_source(spark, told, warehouse, None, run_window(at), f"r{day}", at, tombstone=True,
                          pages=spark.createDataFrame(pages, PAGES), **more)

    first = run(0, cursor_pages(
        (None, "b", [{"id": 1, "at": "2024-01-01T00:00:00Z"}, {"id": 2, "at": None}]),
        ("b", None, [{"id": 3, "at": 1704067200000}])))
    assert first["rows_this_run"] == {"notes": 3} and first["marked_deleted"] == {"notes": 0}
    gap = run(1, cursor_pages((None, "b", [{"id": 1, "at": None}])))
    assert gap["marked_deleted"] == {} and "gaps" in gap["tombstones_skipped"]["notes"]
    loop = run(2, cursor_pages((None, "", [{"id": 1, "at": None}]), ("x", "y", [{"id": 9, "at": None}]),
                               ("y", "x", [{"id": 8, "at": None}])))
    assert loop["marked_deleted"] == {}
    whole = run(3, cursor_pages((None, "", [{"id": 1, "at": None}, {"id": 8, "at": None}])))
    assert whole["marked_deleted"] == {"notes": 3}
    assert {r.id for r in warehouse.read(spark, "notes").filter("_deleted").collect()} == {2, 3, 9}
    # What the caller says counts before what the pages say.
    assert run(4, cursor_pages((None, "", [{"id": 1, "at": None}])), complete={"notes": False})["marked_deleted"] == {}


@pytest.mark.parametrize("missing", [None, 1, 2])
def test_numbered_pages_of_parents(spark, missing):
    told = contract({"type": "page_number", "base_page": 1, "total_path": "meta.pages"})
    notes = told.resource("notes")
    pages = spark.createDataFrame(
        [("notes", parent, page, None, json.dumps({"data": [{"id": 10 * i + page}], "meta": {"pages": 2}}))
         for i, parent in enumerate(["a", "b"]) for page in (1, 2, 3) if (parent, page) != ("b", missing)]
        + [("others", None, 1, None, json.dumps({"data": [{"id": 99}], "meta": {"pages": 7}}))], PAGES)
    want = {1, 2, 11, 12} - ({10 + missing} if missing else set())
    # Page 3 is past the end that page 2 tells; without page 2, page 3 is the first to reach it.
    want |= {13} if missing == 2 else set()
    assert {r.id for r in records_from_pages(pages, told, notes).collect()} == want
    assert chains_complete(pages, told, notes) is (missing is None)


def test_paging_nobody_knows_licenses_nothing(spark):
    pages = spark.createDataFrame(cursor_pages((None, "", [{"id": 1}])), PAGES)
    for kind in (None, "auto", {"type": "auto"}):
        assert chains_complete(pages, contract(kind), contract(kind).resource("notes")) is None
    assert chains_complete(pages, contract("cursor", None), contract("cursor", None).resource("notes")) is None
    assert chains_complete(pages, contract("single_page"), contract("single_page").resource("notes")) is True
    assert chains_complete(pages.limit(0), contract("cursor"), contract("cursor").resource("notes")) is False
    with pytest.raises(ContractError, match="no way of paging"):
        paging_of(contract("offsets"), contract("offsets").resource("notes"))
    own = contract("cursor", endpoint={"paginator": {"type": "page_number", "total_path": "n"}})
    assert paging_of(own, own.resource("notes")).kind == "page_number"


def test_pages_are_read_by_spark(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(json.dumps({"resource": "notes", "page": 1, "body": "{}"}) + "\n")
    assert read_pages(spark, str(tmp_path)).first().page == 1
    (tmp_path / "q.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_pages(spark, str(tmp_path)).collect()


PARTIAL = {
    "window": {"window_field": "at", "window_months": 6},
    "search": {"strategy": "search_window", "cursor_field": "at"},
    "watermark": {"strategy": "parent_watermark", "parent": "other"},
    "fanout": {"strategy": "parent_fanout", "parent": "other", "cursor_field": "at"},
}


@pytest.mark.parametrize("name", PARTIAL)
def test_what_is_read_in_part_is_never_tombstoned(name):
    document = {"name": "desk", "api": API, "orchestration": {"backfill_start": "2020-01-01"}, "resources": [
        {"name": "other", "primary_key": "id"},
        {"name": "notes", "primary_key": "id", "soft_delete": "always", "incremental": PARTIAL[name]}]}
    with pytest.raises(ContractError, match="absence from it means nothing"):
        Contract.from_dict(document)
    settings = {k: v for k, v in PARTIAL[name].items()}
    window = run_window(NOW, start=datetime(2019, 1, 1))
    for mode in ("always", "full_history"):
        told = Contract("desk", (Resource("other", ("id",)), Resource("notes", ("id",), soft_delete=mode, **settings)),
                        orchestration=document["orchestration"])
        plan = soft_delete_eligible(told, told.resources, window, True, {"notes": True})
        assert plan.eligible == () and "returns" in plan.skipped["notes"]


def test_a_full_fanout_may_be_tombstoned():
    document = {"name": "desk", "api": API, "resources": [
        {"name": "other", "primary_key": "id"},
        {"name": "notes", "primary_key": "id", "soft_delete": "always",
         "incremental": {"strategy": "parent_fanout", "parent": "other"}}]}
    told = Contract.from_dict(document)
    assert soft_delete_eligible(told, told.resources, run_window(NOW), True, {"notes": True}).eligible == ("notes",)


def test_two_runs_of_a_rolling_window_mark_nothing(spark, tmp_path):
    told = Contract("desk", (Resource("sent", ("id",), soft_delete="always", window_field="at", window_months=6,
                                      timestamp_columns=("at",)),))
    warehouse = Warehouse(str(tmp_path), "desk", buckets=2)
    for at, months in ((datetime(2024, 6, 15), range(1, 7)), (datetime(2025, 1, 2), range(10, 13))):
        rows = spark.createDataFrame([(m, datetime(2024, m, 1)) for m in months], "id int, at timestamp")
        out = run_source(spark, told, warehouse, {"sent": rows}, run_window(at), at.isoformat()[:10], at,
                         tombstone=True, complete={"sent": True})
        assert out["marked_deleted"] == {}
    assert warehouse.read(spark, "sent").filter("_deleted").count() == 0
