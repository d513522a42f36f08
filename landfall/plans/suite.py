"""The check suite of a source: planned from its contract, run, logged."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from landfall.contract import Contract
from landfall.operators import checks as C
from landfall.operators.merge import evolve_add_columns
from landfall.operators.runlog import RESULT_COLUMNS, RESULT_DEFAULTS
from landfall.operators.shape import landed_key


class MissingTablesError(RuntimeError):
    """Tables the source means nothing without have not landed."""


@dataclass(frozen=True)
class SuitePlan:
    checks: tuple[C.Check, ...]
    skipped: tuple[str, ...] = ()


def plan_suite(
    contract: Contract,
    present: Iterable[str] | None = None,
    freshness_hours: int | None = None,
) -> SuitePlan:
    """Every check the contract implies, narrowed to the tables that landed.

    A table without rows was never created, so its checks are skipped by name;
    an orphan check goes when either side is missing. A required table that is
    missing stops the run. ``freshness_hours`` loosens the contract for one run.
    """
    quality = contract.quality
    landed = set(contract.resource_names if present is None else present)
    absent = [table for table in quality.required if table not in landed]
    if absent:
        raise MissingTablesError(
            f"{contract.dataset}: {', '.join(absent)} did not land; load {contract.name} first"
        )
    planned: list[C.Check] = []
    for resource in contract.resources:
        table = resource.name
        if table not in landed:
            continue
        planned += C.identity(table, landed_key(resource))
        if resource.soft_delete:
            planned.append(C.deleted_fraction(table, quality.max_deleted_fraction))
        planned += [C.not_null(table, column) for column in quality.not_null.get(table, ())]
        fresh = quality.freshness
        if fresh and fresh.table == table:
            hours = fresh.hours if freshness_hours is None else freshness_hours
            planned.append(C.freshness(table, fresh.column, hours, fresh.severity))
        planned += [
            C.orphans(table, edge.child_column, edge.parent_table, edge.parent_column,
                      edge.severity)
            for edge in quality.references
            if edge.child_table == table and edge.parent_table in landed
        ]
    skipped = tuple(name for name in contract.resource_names if name not in landed)
    return SuitePlan(tuple(planned), skipped)


def validate_suite(
    spark: SparkSession,
    contract: Contract,
    tables: Mapping[str, DataFrame],
    as_of: datetime,
    freshness_hours: int | None = None,
) -> DataFrame:
    """All verdicts of a source as one lazy DataFrame, one row per check."""
    plan = plan_suite(contract, tables.keys(), freshness_hours)
    return C.evaluate(spark, tables, plan.checks, contract.dataset, as_of)


def log_rows(
    results: DataFrame, validated_at: datetime, context: Mapping[str, str | None] | None = None
) -> DataFrame:
    """Verdicts in the log's column order, stamped with when and by what."""
    context = context or {}
    stamped = evolve_add_columns(results, RESULT_DEFAULTS).withColumns(
        {name: F.lit(context.get(name)).cast("string")
         for name in ("dag_id", "dag_run_id", "task_id")}
    )
    moment = F.lit(validated_at.isoformat(sep=" ")).cast("timestamp")
    return stamped.select(moment.alias("validated_at"), *RESULT_COLUMNS)


def write_append(rows: DataFrame, path: str, moment: str) -> None:
    """Append to a log that is laid out by day, so a question about last night
    reads last night's files."""
    rows.withColumn("_day", F.to_date(moment)).write.mode("append").partitionBy("_day").parquet(
        path
    )


def run_suite(
    spark: SparkSession,
    contract: Contract,
    tables: Mapping[str, DataFrame],
    as_of: datetime,
    log_path: str | None = None,
    context: Mapping[str, str | None] | None = None,
    freshness_hours: int | None = None,
) -> tuple[DataFrame, Row | None]:
    """Run, log and judge. Verdict rows, one per declared check, are gathered
    once so that the log and the judgement see the same ones. A log that cannot
    be written does not hide the verdict."""
    plan = plan_suite(contract, tables.keys(), freshness_hours)
    arguments = (spark, tables, plan.checks, contract.dataset, as_of)
    try:
        rows = C.evaluate(*arguments).collect()
    except C.SPARK_ERRORS:
        rows = C.evaluate_each(*arguments).collect()
    results = spark.createDataFrame(rows, C.RESULT_SCHEMA).coalesce(1)
    if log_path is not None:
        try:
            write_append(log_rows(results, as_of, context), log_path, "validated_at")
        except C.SPARK_ERRORS as error:
            print(f"the verdicts could not be logged: {C.error_text(error)}")
    return results, C.suite_verdict(results).first()


