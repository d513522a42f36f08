"""The stream form: every file once, replays harmless, late rows merged."""

from datetime import datetime

import pytest

from landfall.contract import Resource
from landfall.plans.warehouse import Warehouse
from landfall.streaming.upsert import landed_files, stream_upsert

SCHEMA = "id bigint, at timestamp, value string"
RESOURCE = Resource("events", ("id",), soft_delete="always", promote={"value": "copy"})
T = datetime(2024, 1, 1)


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "in"), Warehouse(str(tmp_path / "w"), "s", 4), str(tmp_path / "ckpt")


def deliver(spark, folder, *rows):
    spark.createDataFrame([(i, T, v) for i, v in rows], SCHEMA).coalesce(1).write.mode(
        "append").parquet(folder)


def drain(spark, place, **settings):
    folder, warehouse, checkpoint = place
    stream_upsert(landed_files(spark, folder, SCHEMA, **settings), warehouse, RESOURCE, checkpoint)
    found = warehouse.read(spark, "events").select("id", "copy", "_deleted").collect()
    return sorted(tuple(row) for row in found)


def test_each_start_merges_what_arrived_since(spark, place):
    deliver(spark, place[0], (1, "a"), (2, "b"))
    assert drain(spark, place) == [(1, "a", False), (2, "b", False)]
    deliver(spark, place[0], (2, "B"), (3, "c"))
    assert drain(spark, place) == [(1, "a", False), (2, "B", False), (3, "c", False)]
    assert drain(spark, place) == [(1, "a", False), (2, "B", False), (3, "c", False)]


def test_files_are_merged_in_order_of_arrival(spark, place):
    for value in "abc":
        deliver(spark, place[0], (1, value))
    assert drain(spark, place, files_per_batch=1) == [(1, "c", False)]
    loads = place[1].ledger(spark).filter("state = 'committed'")
    assert loads.count() == 3


@pytest.mark.parametrize("lost", ["_switch", "_enter"])
def test_a_batch_that_dies_midway_lands_once(spark, place, monkeypatch, lost):
    """The driver goes away while switching, or after it but before the entry."""
    original = getattr(Warehouse, lost)

    def die(self, *arguments):
        if lost == "_switch" or arguments[-1] == "committed":
            raise RuntimeError("lost")
        return original(self, *arguments)

    deliver(spark, place[0], (1, "a"), (2, "b"))
    monkeypatch.setattr(Warehouse, lost, die)
    with pytest.raises(Exception, match="lost"):
        drain(spark, place)
    monkeypatch.undo()
    deliver(spark, place[0], (2, "B"))
    assert drain(spark, place) == [(1, "a", False), (2, "B", False)]
    committed = place[1].ledger(spark).filter("state = 'committed'")
    assert committed.count() == committed.distinct().count() == 2


def test_a_stream_that_starts_over_is_another_stream(spark, place, tmp_path):
    deliver(spark, place[0], (1, "a"))
    drain(spark, place)
    deliver(spark, place[0], (1, "b"))
    again = (place[0], place[1], str(tmp_path / "other"))
    assert drain(spark, again, files_per_batch=1) == [(1, "b", False)]
