"""Which rows each fetch strategy admits, and how its cursor moves.

Bounds are literals of the column's own type, so they reach the file scan as
plain comparisons. Worklists stay DataFrames.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from landfall.operators.joins import splittable
from landfall.operators.merge import merge_upsert
from landfall.operators.shape import inject_parent

# What to do with rows whose cursor is null.
CURSOR_MISSING_POLICIES = ("include", "exclude", "raise")

_EPOCH = datetime(1970, 1, 1)


def bound_text(df: DataFrame, column: str, moment: datetime) -> str:
    """``moment`` as a SQL literal of the column's type; naive moments are UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    kind = df.schema[column].dataType.simpleString()
    return f"CAST(TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}' AS {kind})"


def typed_bound(df: DataFrame, column: str, moment: datetime) -> Column:
    return F.expr(bound_text(df, column, moment))


def effective_cursor(
    state: datetime | None, initial_value: datetime | None = None
) -> datetime | None:
    """The stored cursor; the first-run floor only when nothing is stored."""
    return initial_value if state is None else state


def with_lookback(cursor: datetime | None, seconds: int) -> datetime | None:
    return None if cursor is None else cursor - timedelta(seconds=seconds)


def admit_since(
    rows: DataFrame, cursor: str, since: datetime | None, missing: str = "include"
) -> DataFrame:
    """Rows at or after ``since``, and the null-cursor rows as ``missing`` says."""
    if missing not in CURSOR_MISSING_POLICIES:
        raise ValueError(
            f"unknown policy {missing!r}; known are {', '.join(CURSOR_MISSING_POLICIES)}"
        )
    moment = F.col(cursor)
    reached = F.lit(True) if since is None else moment >= typed_bound(rows, cursor, since)
    if missing == "include":
        return rows if since is None else rows.filter(reached | moment.isNull())
    if missing == "exclude":
        return rows.filter(reached & moment.isNotNull())
    complaint = F.raise_error(F.lit(f"a row has no {cursor}")).cast("boolean")
    return rows.filter(F.when(moment.isNull(), complaint).otherwise(reached))


def search_window(
    rows: DataFrame,
    cursor: str,
    last: datetime | None,
    lookback_seconds: int = 0,
    initial_value: datetime | None = None,
    missing: str = "include",
) -> DataFrame:
    """Rows changed since the last cursor less a lookback; a first run is unbounded."""
    start = effective_cursor(last, initial_value)
    return admit_since(rows, cursor, with_lookback(start, lookback_seconds), missing)


def full_refresh(target: DataFrame, fetched: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The whole collection, merged. Absence from it means something."""
    return merge_upsert(target, fetched, keys)


def rolling_refetch(rows: DataFrame, created: str, as_of: datetime, months: int) -> DataFrame:
    """The trailing window a source lets itself be asked for, read again every run."""
    kind = rows.schema[created].dataType
    floor = F.add_months(typed_bound(rows, created, as_of).cast("date"), -months)
    return rows.filter(F.col(created) >= floor.cast("timestamp_ntz").cast(kind))


def parent_fanout(
    children: DataFrame,
    parents: DataFrame,
    foreign_key: str,
    parent_key: str,
    cursor: str | None = None,
    last: datetime | None = None,
    lookback_seconds: int = 0,
    missing: str = "raise",
) -> DataFrame:
    """Children of every listed parent, bounded by the child's own cursor; ``missing`` says
    what becomes of children without one, on every run alike.

    Without a cursor the children are read in full. An empty parent list is an
    error: every child table would look like a source without data.
    """
    if parents.isEmpty():
        raise RuntimeError("no parents are listed, so every child would be missed")
    listed = parents.select(F.col(parent_key).alias(foreign_key))
    if cursor is not None:
        since = with_lookback(last, lookback_seconds)
        children = admit_since(children, cursor, since, missing)
    return children.filter(F.col(foreign_key).isNotNull()).join(listed, foreign_key, "left_semi")


def changed_parents(
    parents: DataFrame,
    parent_key: str,
    changed_at: str,
    watermark: datetime | None,
    lookback_seconds: int = 0,
    initial_watermark: datetime | None = None,
) -> DataFrame:
    """The worklist: one row per parent changed since the watermark less a lookback.

    A watermark that never left the epoch bounds nothing.
    """
    reached = effective_cursor(watermark, initial_watermark)
    start = None if reached == _EPOCH else with_lookback(reached, lookback_seconds)
    missing = "include" if start is None else "exclude"
    return (
        admit_since(parents, changed_at, start, missing)
        .filter(F.col(parent_key).isNotNull())
        .groupBy(parent_key)
        .agg(F.max(changed_at).alias(changed_at))
    )


def parent_watermark(
    children: DataFrame,
    worklist: DataFrame,
    foreign_key: str,
    parent_key: str,
    changed_at: str,
    changed_name: str,
) -> DataFrame:
    """Every child of every listed parent, with the parent's id and changed-at.

    The worklist is unique on its key, so a child appears once; a parent that has
    a large share of all children is split over tasks.
    """
    listed = splittable(worklist, [parent_key]).select(
        F.col(parent_key).alias("_listed_id"), F.col(changed_at).alias("_listed_at")
    )
    met = children.join(listed, F.col(foreign_key) == F.col("_listed_id"), "inner")
    return inject_parent(
        met, F.col("_listed_id"), F.col("_listed_at"), foreign_key, changed_name
    ).drop("_listed_id", "_listed_at")


def advance_watermark(
    worklist: DataFrame, changed_at: str, watermark: datetime | None
) -> DataFrame:
    """How far the worklist reached: one row, ``watermark``. It never goes back.

    Taken over the parents, so those without children count too.
    """
    old = typed_bound(worklist, changed_at, watermark or _EPOCH)
    zero = typed_bound(worklist, changed_at, _EPOCH)
    reached = F.max(F.coalesce(F.col(changed_at), zero))
    return worklist.agg(F.greatest(old, reached).alias("watermark"))


def backfill_window(
    rows: DataFrame, moment: str, start: datetime, end: datetime, missing: str = "include"
) -> DataFrame:
    """Rows of the half-open window a backfill asked for, and those without a moment as
    ``missing`` says: no window will ever ask for them by name."""
    before = F.col(moment).isNull() | (F.col(moment) < typed_bound(rows, moment, end))
    return admit_since(rows, moment, start, missing).filter(before)


def cursor_state(states: DataFrame) -> DataFrame:
    """The newest state per source, resource and destination of the append-only log."""
    order = F.struct("saved_at", "load_id")
    return states.groupBy("source", "resource", "destination").agg(
        F.max_by("cursor", order).alias("cursor"),
        F.max("saved_at").alias("saved_at"),
    )


def pending_loads(prepared: DataFrame, committed: DataFrame) -> DataFrame:
    """Loads that were prepared but never committed: to be finished before a new
    fetch, and not part of the new run."""
    return prepared.join(
        committed.select("table_name", "load_id"), ["table_name", "load_id"], "left_anti"
    )
