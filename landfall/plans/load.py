"""One run of a source: recover, land every resource, tombstone, report."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import groupby
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.contract import Contract, ContractError, Resource, RunWindow
from landfall.functions.naming import snake_case
from landfall.operators import incremental as I
from landfall.operators.requests import requests_by_family, routes_of
from landfall.operators.runlog import (
    RUN_COLUMNS,
    record_run,
    schema_changes,
    schema_rows,
    table_counts,
)
from landfall.operators.shape import landed_key, landed_rows, sample_landed
from landfall.operators.tombstone import soft_delete_eligible
from landfall.plans.suite import write_append
from landfall.plans.warehouse import Warehouse
from landfall.sources.landed import chains_complete, records_from_pages

# A builder returns the raw records of a resource that no plain table holds. It
# is registered as ``build_<resource>``, or as ``build_resource`` for all.
Builder = Callable[[SparkSession, Contract, Resource, datetime | None], DataFrame]

PARENT_CHANGED_AT = "_parent_changed_at"


@dataclass
class Run:
    spark: SparkSession
    contract: Contract
    warehouse: Warehouse
    run_id: str
    started_at: datetime
    window: RunWindow
    records: Mapping[str, DataFrame]
    builders: Mapping[str, Builder] = field(default_factory=dict)
    pages: DataFrame | None = None
    worklists: dict[tuple[str, Any], DataFrame] = field(default_factory=dict)
    lock: Lock = field(default_factory=Lock)

    def load_id(self, resource: Resource) -> str:
        return f"{self.run_id}-{resource.name}"

    def records_of(self, resource: Resource, state: datetime | None) -> DataFrame:
        """Raw records of a resource. Having none to read is an error: skipping it
        would look like a source without data."""
        builder = self.builders.get(f"build_{resource.name}")
        if builder is None and resource.name not in self.records:
            builder = self.builders.get("build_resource")
        if builder is not None:
            return builder(self.spark, self.contract, resource, state)
        if resource.name not in self.records and self.pages is not None:
            return records_from_pages(self.pages, self.contract, resource)
        if resource.name not in self.records:
            raise ContractError(
                f"{self.contract.name}: nothing supplies {resource.name} "
                f"(strategy {resource.strategy})"
            )
        return self.records[resource.name]

    def edge_to_parent(self, resource: Resource) -> tuple[str, str] | None:
        """(foreign key, parent key) of the declared edge to the parent."""
        for edge in self.contract.quality.references:
            if edge.child_table == resource.name and edge.parent_table == resource.parent:
                return edge.child_column, edge.parent_column
        return None

    def parent_rows(self, resource: Resource) -> DataFrame:
        parents = self.warehouse.read(self.spark, resource.parent) if resource.parent else None
        if parents is None:
            raise ContractError(
                f"{self.contract.name}.{resource.name}: parent {resource.parent} has not landed"
            )
        return parents

    def worklist(self, resource: Resource, parent_key: str, since: datetime | None) -> DataFrame:
        """Changed parents, found once for all the children that ask alike."""
        parent = self.contract.resource(resource.parent)
        if not parent.cursor_field:
            raise ContractError(f"{parent.name}: a watched parent needs a cursor_field")
        key = (parent.name, parent_key, since, resource.lookback_seconds)
        with self.lock:
            if key not in self.worklists:
                self.worklists[key] = I.changed_parents(
                    self.parent_rows(resource), parent_key, snake_case(parent.cursor_field),
                    since, resource.lookback_seconds,
                ).persist()
            return self.worklists[key]


def run_source(
    spark: SparkSession,
    contract: Contract,
    warehouse: Warehouse,
    records: Mapping[str, DataFrame] | None,
    window: RunWindow,
    run_id: str,
    started_at: datetime,
    resources: str = "all",
    tombstone: bool = False,
    complete: Mapping[str, bool] | None = None,
    builders: Mapping[str, Builder] | None = None,
    requests: DataFrame | None = None,
    context: Mapping[str, str | None] | None = None,
    publish: bool = False,
    sample: int = 0,
    parallel: int = 4,
    pages: DataFrame | None = None,
) -> dict[str, Any]:
    """Land the selected resources and return the run's summary, which is also
    appended to the run log, whether the run succeeds or fails.

    Resources that are read whole go first, so that worklists see their parents;
    up to ``parallel`` resources that do not wait for each other land side by side.
    ``requests`` are the URLs (column ``url``) this run asked for, ``complete`` says
    per table whether its page chain was whole, and ``sample`` prints that many rows
    of each table as they landed.

    ``pages`` are landed response pages (see ``sources.landed``): what neither ``records`` nor
    a builder supplies is read from them as the contract says, and whether their chains
    are whole is taken from them for every table that ``complete`` is silent about.
    """
    records = records or {}
    depth = _after_parents(contract)
    selected = sorted(contract.select(resources), key=depth)
    run = Run(spark, contract, warehouse, run_id, started_at, window, records, builders or {}, pages)
    clock = time.monotonic()
    summary: dict[str, Any] = {
        "started_at": started_at.isoformat(), "mode": window.mode,
        "destination": warehouse.destination, "resources": [r.name for r in selected],
        "load_ids": [], "rows_this_run": {}, "warehouse_counts": {}, "status": "failed",
        "requests_by_family": {}, **(context or {}),
    }
    if window.mode == "window":
        # These bound themselves by their own cursor, whatever range was asked for.
        summary["window_ignored_by"] = [
            r.name for r in selected if r.strategy in ("parent_fanout", "parent_watermark")
        ]
    try:
        summary["recovered"] = warehouse.recover(spark)
        before = _schemas(run, selected)
        for _, level in groupby(selected, key=depth):
            together = list(level)
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                landed = list(pool.map(lambda resource: _land(run, resource), together))
            for resource, (rows, told) in zip(together, landed):
                summary["load_ids"].append(run.load_id(resource))
                # What the staging write counted is what landed: nothing is scanned to find it again.
                summary["rows_this_run"][resource.name] = told["rows"]
                if sample:
                    print(f"{resource.name}, as landed:")
                    sample_landed(rows, landed_key(resource), sample).show(
                        sample, truncate=False, vertical=True
                    )
        if tombstone:
            complete = {**_chains_seen(run, selected), **(complete or {})}
        plan = soft_delete_eligible(contract, selected, window, tombstone, complete)
        summary["marked_deleted"] = warehouse.mark_deleted(
            spark, plan.eligible, summary["load_ids"]
        )
        summary["tombstones_skipped"] = dict(plan.skipped)
        summary["schema_changes"] = [
            tuple(row) for row in schema_changes(_schemas(run, selected), before).collect()
        ]
        if requests is not None:
            summary["requests_by_family"] = _as_dict(
                requests_by_family(requests, "url", routes_of(contract))
            )
        tables = warehouse.read_all(spark, [r.name for r in selected])
        summary["warehouse_counts"] = _as_dict(table_counts(spark, tables))
        if publish:
            warehouse.publish(spark, list(tables))
        summary["status"] = "succeeded"
    finally:
        for worklist in run.worklists.values():
            worklist.unpersist()
        summary["elapsed_seconds"] = time.monotonic() - clock
        _log(run, summary)
    return summary


def _chains_seen(run: Run, selected: Sequence[Resource]) -> dict[str, bool]:
    """Of the tables read from pages that could be tombstoned: was every chain of theirs read whole?"""
    if run.pages is None:
        return {}
    seen = {
        resource.name: chains_complete(run.pages, run.contract, resource)
        for resource in selected
        if resource.soft_delete and resource.name not in run.records
        and not {f"build_{resource.name}", "build_resource"} & set(run.builders)
    }
    return {name: whole for name, whole in seen.items() if whole is not None}


def _after_parents(contract: Contract) -> Callable[[Resource], int]:
    def depth(resource: Resource) -> int:
        if resource.strategy == "full_refresh":
            return 0
        known = resource.parent in contract.resource_names and resource.parent != resource.name
        return 1 + (depth(contract.resource(resource.parent)) if known else 0)

    return depth


def _schemas(run: Run, selected: Sequence[Resource]) -> DataFrame:
    """The landed schemas as rows: one per column of the contract's tables."""
    tables = run.warehouse.read_all(run.spark, [r.name for r in selected])
    return schema_rows(run.spark, {n: rows for n, rows in tables.items() if rows is not None})


def _land(run: Run, resource: Resource) -> tuple[DataFrame, dict[str, Any]]:
    """Fetch by strategy, land, then move the cursor: data, ledger, ranges, cursor. Returns
    the rows that landed and what their write counted."""
    spark, warehouse = run.spark, run.warehouse
    state = warehouse.cursor(spark, resource.name)
    load_id = run.load_id(resource)
    rows = landed_rows(run.records_of(resource, state), resource, load_id)
    cursor = snake_case(resource.cursor_field) if resource.cursor_field else None
    reached: DataFrame | None = None

    if resource.strategy == "search_window":
        if cursor is None:
            raise ContractError(f"{resource.name}: search_window needs a cursor_field")
        if run.window.mode == "window":
            rows = I.backfill_window(
                rows, cursor, run.window.start, run.window.end, resource.cursor_missing or "include"
            )
        else:
            rows = I.search_window(
                rows, cursor, state, resource.lookback_seconds, resource.initial_value,
                resource.cursor_missing or "include",
            )
    elif resource.strategy == "full_refresh" and resource.window_field:
        rows = I.rolling_refetch(
            rows, snake_case(resource.window_field), run.started_at, resource.window_months
        )
    elif resource.strategy == "parent_fanout":
        edge = run.edge_to_parent(resource)
        reached_before = I.effective_cursor(state, resource.initial_value)
        missing = resource.cursor_missing or "raise"
        if edge is not None:
            rows = I.parent_fanout(
                rows, run.parent_rows(resource), *edge, cursor, reached_before,
                resource.lookback_seconds, missing,
            )
        elif cursor is not None:
            since = I.with_lookback(reached_before, resource.lookback_seconds)
            rows = I.admit_since(rows, cursor, since, missing)
    elif resource.strategy == "parent_watermark":
        edge = run.edge_to_parent(resource)
        if edge is None:
            raise ContractError(f"{resource.name}: no declared edge to {resource.parent}")
        changed_at = snake_case(run.contract.resource(resource.parent).cursor_field or "")
        worklist = run.worklist(resource, edge[1], state)
        rows = I.parent_watermark(rows, worklist, *edge, changed_at, PARENT_CHANGED_AT)
        reached = I.advance_watermark(worklist, changed_at, state)

    told: dict[str, Any] = {}
    staged = warehouse.land(
        resource.name, rows, landed_key(resource), load_id, resource.write_disposition, cursor, told
    )
    newest = told["newest"]
    if reached is not None:
        newest = reached.select(F.col("watermark").cast("timestamp")).first()[0]
    if resource.strategy == "search_window":
        newest = _known_without_gap(run, resource, state, newest)
    if newest is not None and (state is None or newest > state):
        warehouse.save_cursor(spark, resource.name, newest, load_id, run.started_at)
    return staged, told


def _known_without_gap(
    run: Run, resource: Resource, state: datetime | None, newest: datetime | None
) -> datetime | None:
    """Enter what this run read in the log of ranges, and tell how far the resource is known
    from its floor on. A cursor that moved over a gap would never come back for it; once
    windows close the gap, in whatever order, it moves over all of them."""
    spark, warehouse, window = run.spark, run.warehouse, run.window
    floor = _naive(state or resource.initial_value)
    if window.mode == "window":
        start, end = _naive(window.start), _naive(window.end)
        if window.end_is_current:    # what comes in later may still be older than now
            end = newest
        if floor is None and run.contract.backfill_start:
            floor = _naive(datetime.fromisoformat(run.contract.backfill_start))
    else:
        start, end = I.with_lookback(floor, resource.lookback_seconds), newest
    warehouse.save_range(spark, resource.name, start, end, newest, run.load_id(resource), run.started_at)
    if floor is None:
        return newest if window.mode != "window" else None
    known = warehouse.covered(spark, resource.name, floor)
    return known if known is not None and known > floor else None


def _naive(moment: datetime | None) -> datetime | None:
    """As the session holds it: in UTC, without a zone."""
    if moment is None or moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def _as_dict(counts: DataFrame) -> dict[str, int | None]:
    """One entry per table of the contract."""
    return {row[0]: row[1] for row in counts.collect()}


def _log(run: Run, summary: Mapping[str, Any]) -> None:
    texts = {
        name: json.dumps(value, default=str) if isinstance(value, (list, dict)) else value
        for name, value in summary.items()
        if name in RUN_COLUMNS
    }
    schema = ", ".join(
        f"{name} {'double' if name == 'elapsed_seconds' else 'string'}" for name in texts
    )
    row = record_run(run.spark.createDataFrame([tuple(texts.values())], schema).coalesce(1))
    moment = F.lit(run.started_at.isoformat(sep=" ")).cast("timestamp")
    write_append(
        row.select(moment.alias("recorded_at"), *row.columns),
        f"{run.warehouse.base}/_run_log", "recorded_at",
    )


