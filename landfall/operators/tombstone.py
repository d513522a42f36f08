"""Soft delete: rows a complete fetch no longer returned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.contract import WINDOWED_STRATEGIES, Contract, Resource, RunWindow, read_in_part
from landfall.operators.joins import splittable
from landfall.operators.shape import DELETED, LOAD_ID


def is_stale(load_ids: Sequence[str]) -> Column:
    """Not landed by this run and not marked yet.

    A null load id or a null flag makes this null, and such rows stay as they are.
    """
    return ~F.col(LOAD_ID).isin(*load_ids) & ~F.col(DELETED)


def mark_deleted(rows: DataFrame, load_ids: Sequence[str]) -> DataFrame:
    """Stale rows flagged. Without load ids nothing was fetched, so nothing is."""
    if not load_ids:
        return rows
    flagged = F.when(is_stale(load_ids), F.lit(True)).otherwise(F.col(DELETED))
    return rows.withColumn(DELETED, flagged)


def mark_deleted_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], load_ids: Sequence[str]
) -> DataFrame:
    """Rows to mark per table; a table that never landed has none."""
    if not load_ids or not tables:
        return spark.createDataFrame([], "table_name string, marked bigint")
    return reduce(
        DataFrame.unionByName,
        [
            (rows.agg(F.count_if(is_stale(load_ids)).alias("marked")) if rows is not None
             else spark.range(1).select(F.lit(0).cast("bigint").alias("marked")))
            .select(F.lit(name).alias("table_name"), "marked")
            for name, rows in tables.items()
        ],
    )


def absent_keys(target: DataFrame, fetched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the target holds that a complete fetch did not return."""
    returned = splittable(fetched.select(*keys).distinct(), keys)
    return target.select(*keys).join(returned, list(keys), "left_anti")


@dataclass(frozen=True)
class SoftDeletePlan:
    eligible: tuple[str, ...]
    skipped: Mapping[str, str]


def soft_delete_eligible(
    contract: Contract,
    selected: Sequence[Resource],
    window: RunWindow,
    requested: bool,
    complete: Mapping[str, bool] | None = None,
) -> SoftDeletePlan:
    """The tables a run may tombstone, and why the others may not.

    A table of which a run only ever reads a part (a search, a rolling window, a worklist) is
    never one of them. ``complete`` tells, per table, whether its page chain was read to its end; a table whose
    chain has gaps, or of which nothing is said, is never tombstoned.
    """
    if not requested:
        return SoftDeletePlan((), {})
    eligible, skipped = [], {}
    for resource in selected:
        if resource.soft_delete is None:
            continue
        reason = read_in_part(resource)
        if reason is None and resource.soft_delete == "full_history":
            reason = _partial_history(contract, resource, window)
        if reason:
            skipped[resource.name] = reason
            continue
        if not (complete or {}).get(resource.name, False):
            known = complete is not None and resource.name in complete
            skipped[resource.name] = (
                "its page chain has gaps" if known else "nothing says that it was read whole")
            continue
        eligible.append(resource.name)
    return SoftDeletePlan(tuple(eligible), skipped)


def _partial_history(contract: Contract, resource: Resource, window: RunWindow) -> str | None:
    if resource.strategy not in WINDOWED_STRATEGIES:
        return f"the window does not reach strategy {resource.strategy}"
    floor = contract.backfill_start
    if window.mode != "window" or floor is None:
        return "the run did not cover all of history"
    if _utc(window.start) > _utc(datetime.fromisoformat(floor)) or not window.end_is_current:
        return f"the run must start by {floor} and reach the present"
    return None


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment
