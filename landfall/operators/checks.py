"""Contract checks, compiled so that a table is read as few times as possible.

Per table: one grouping by key answers uniqueness, key nulls and row count
together; one aggregate answers every other single-table check; one anti join
per declared edge answers orphans. Groupings combine before they shuffle, so a
hot key or a hot foreign key is one row per task by the time it moves.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from landfall.functions.text import truncate_observed
from landfall.operators.incremental import bound_text
from landfall.operators.shape import DELETED

# What a verdict row calls its check.
UNEXPECTED_ROWS = "unexpected_rows_expectation"
ROW_COUNT = "expect_table_row_count_to_be_between"

# The sentences a verdict carries.
SENTENCES = {
    "not_null": "{table}.{column} is never null",
    "unique": "{table}.{column} is unique",
    "unique_composite": "{table} ({columns}) is unique",
    "row_count": "{table} has at least one row "
                 "(an empty table means the fetch failed silently)",
    "freshness": "{table}.{column} is within the last {hours}h",
    "freshness_warn": " (advisory: a quiet source looks the same as a stalled pipeline here)",
    "deleted_fraction": "at most {fraction:.0%} of {table} is tombstoned "
                        "(more than that means a partial fetch was soft-deleted)",
    "orphans": "every {table}.{column} resolves to a loaded {parent}",
    "orphans_warn": " (advisory: the source itself retains children whose parent is gone)",
}

RESULT_SCHEMA = T.StructType([
    T.StructField("checkpoint", T.StringType()),
    T.StructField("suite", T.StringType()),
    T.StructField("asset", T.StringType()),
    T.StructField("expectation", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("severity", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("observed_value", T.StringType()),
    T.StructField("details", T.StringType()),
])


# What a query that cannot be planned, and a job that fails, raise.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


# ── Checks as relations: the unexpected rows themselves ──────────────────────


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once, with how often; nulls form a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") > 1)


def orphan_rows(
    children: DataFrame, child_column: str, parents: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose non-null foreign key has no parent. Nulls leave before the join,
    so they never gather in one task."""
    known = parents.select(F.col(parent_column).alias(child_column))
    return children.filter(F.col(child_column).isNotNull()).join(
        known.filter(F.col(child_column).isNotNull()), child_column, "left_anti"
    )


def orphan_keys(
    children: DataFrame, child_column: str, parents: DataFrame, parent_column: str
) -> DataFrame:
    """Each orphaned key once, with its number of rows: the form the suite counts."""
    used = (
        children.filter(F.col(child_column).isNotNull())
        .groupBy(child_column)
        .agg(F.count(F.lit(1)).alias("orphans"))
    )
    known = parents.filter(F.col(parent_column).isNotNull()).select(
        F.col(parent_column).alias(child_column)
    ).distinct()
    return used.join(known, child_column, "left_anti")


# ── Checks as verdicts ───────────────────────────────────────────────────────


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    description: str = ""
    expectation: str = UNEXPECTED_ROWS
    settings: Mapping[str, Any] = field(default_factory=dict)

    @property
    def column_name(self) -> str | None:
        return self.columns[0] if len(self.columns) == 1 else None


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, (column,),
                 description=SENTENCES["not_null"].format(table=table, column=column))


def unique(table: str, keys: Sequence[str]) -> Check:
    if len(keys) == 1:
        text = SENTENCES["unique"].format(table=table, column=keys[0])
    else:
        text = SENTENCES["unique_composite"].format(table=table, columns=", ".join(keys))
    return Check("unique", table, tuple(keys), description=text)


def row_count(table: str) -> Check:
    return Check("row_count", table, description=SENTENCES["row_count"].format(table=table),
                 expectation=ROW_COUNT)


def identity(table: str, keys: Sequence[str]) -> list[Check]:
    """What every table must satisfy, whatever its contract says."""
    return [*[not_null(table, key) for key in keys], unique(table, keys), row_count(table)]


def freshness(table: str, column: str, hours: int, severity: str = "warn") -> Check:
    text = SENTENCES["freshness"].format(table=table, column=column, hours=hours)
    if severity == "warn":
        text += SENTENCES["freshness_warn"]
    return Check("freshness", table, (column,), severity, text, settings={"hours": hours})


def deleted_fraction(table: str, fraction: float) -> Check:
    text = SENTENCES["deleted_fraction"].format(table=table, fraction=fraction)
    return Check("deleted_fraction", table, (DELETED,), description=text,
                 settings={"fraction": fraction})


def orphans(
    table: str, column: str, parent_table: str, parent_column: str, severity: str = "error"
) -> Check:
    text = SENTENCES["orphans"].format(table=table, column=column, parent=parent_table)
    if severity == "warn":
        text += SENTENCES["orphans_warn"]
    return Check("orphans", table, (column,), severity, text,
                 settings={"parent": f"{parent_table}.{parent_column}"})


def evaluate(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    checkpoint: str,
    as_of: datetime,
) -> DataFrame:
    """One verdict row per check, as one lazy DataFrame over all tables.

    The passes yield one number per check; names and sentences, one row per
    declared check, are joined on at the end. A check that cannot be planned
    (a missing column, say) becomes a failed row carrying its error; the others
    are unaffected.
    """
    numbered = list(enumerate(checks))
    passes: list[DataFrame] = []
    errors: dict[int, str] = {}
    for table in dict.fromkeys(check.table for check in checks):
        own = [(number, check) for number, check in numbered if check.table == table]
        for measure, grouped in _passes(tables, own, as_of):
            passes += _planned(measure, grouped, errors)
    labels = spark.createDataFrame(
        [(number, *_labels(check, checkpoint), errors.get(number)) for number, check in numbered],
        _LABEL_SCHEMA,
    ).coalesce(1)
    measured = reduce(DataFrame.union, passes) if passes else spark.createDataFrame(
        [], "check_no int, observed bigint"
    )
    # One row per declared check on either side.
    return labels.join(F.broadcast(measured), "check_no", "left").select(*_verdict_columns())


def evaluate_each(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    checkpoint: str,
    as_of: datetime,
) -> DataFrame:
    """The slow path for when data itself makes a check raise: each check is its
    own job, so one that fails hides no other. Verdicts are one row per declared
    check, which is all that comes back to the driver."""
    rows = []
    for check in checks:
        try:
            rows += evaluate(spark, tables, [check], checkpoint, as_of).collect()
        except SPARK_ERRORS as error:
            failed = (0, *_labels(check, checkpoint), error_text(error), None)
            schema = f"{_LABEL_SCHEMA}, observed bigint"
            rows += spark.createDataFrame([failed], schema).select(*_verdict_columns()).collect()
    return spark.createDataFrame(rows, RESULT_SCHEMA).coalesce(1)


# A pass measures several checks in one reading: a single row with the number of
# unexpected rows (or of rows) of check ``i`` in column ``c<i>``.
Numbered = tuple[int, Check]
Pass = Callable[[list[Numbered]], DataFrame]


def _passes(
    tables: Mapping[str, DataFrame], own: list[Numbered], as_of: datetime
) -> list[tuple[Pass, list[Numbered]]]:
    rows = tables[own[0][1].table]
    keys = next((check.columns for _, check in own if check.kind == "unique"), ())
    by_key = [
        (number, check) for number, check in own
        if (check.kind == "unique" and check.columns == keys)
        or (keys and check.kind == "row_count")
        or (check.kind == "not_null" and check.columns[0] in keys)
    ]
    rest = [entry for entry in own if entry not in by_key]
    single = [entry for entry in rest if entry[1].kind not in ("orphans", "unique")]
    passes: list[tuple[Pass, list[Numbered]]] = [
        (lambda group: _by_key(rows, keys, group), by_key),
        (lambda group: _single_pass(rows, group, as_of), single),
    ]
    for entry in rest:
        if entry[1].kind == "unique":
            passes.append((lambda group: _by_key(rows, group[0][1].columns, group), [entry]))
        elif entry[1].kind == "orphans":
            passes.append((lambda group: _orphan_count(tables, group[0]), [entry]))
    return [(measure, group) for measure, group in passes if group]


def _planned(measure: Pass, group: list[Numbered], errors: dict[int, str]) -> list[DataFrame]:
    """One pass as rows of (check_no, observed); if it cannot be planned, each of
    its checks on its own, noting the error of those that cannot."""
    try:
        entries = ", ".join(f"{number}, c{number}" for number, _ in group)
        return [measure(group).selectExpr(
            f"stack({len(group)}, {entries}) AS (check_no, observed)"
        )]
    except PySparkException as error:
        if len(group) == 1:
            errors[group[0][0]] = error_text(error)
            return []
    return [part for entry in group for part in _planned(measure, [entry], errors)]


def _measured(rows: DataFrame, counts: Mapping[int, str]) -> DataFrame:
    return rows.agg(*[
        F.expr(f"CAST({count} AS BIGINT) AS c{number}") for number, count in counts.items()
    ])


def _by_key(rows: DataFrame, keys: Sequence[str], group: list[Numbered]) -> DataFrame:
    """From one grouping: how often each key occurs tells duplicates, null keys and
    the number of rows."""
    seen = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_seen"))
    counts = {}
    for number, check in group:
        if check.kind == "unique":
            counts[number] = "count_if(_seen > 1)"
        elif check.kind == "row_count":
            counts[number] = "coalesce(sum(_seen), 0)"
        else:
            null = f"`{check.columns[0]}` IS NULL"
            counts[number] = f"coalesce(sum(CASE WHEN {null} THEN _seen END), 0)"
    return _measured(seen, counts)


def _single_pass(rows: DataFrame, group: list[Numbered], as_of: datetime) -> DataFrame:
    """Every check that needs no grouping: one aggregate, no shuffle of rows."""
    return _measured(rows, {number: _count_of(rows, check, as_of) for number, check in group})


def _count_of(rows: DataFrame, check: Check, as_of: datetime) -> str:
    """A whole-table condition counts as one unexpected row, or none. An empty
    table meets it."""
    if check.kind == "row_count":
        return "count(1)"
    column = check.columns[0]
    if check.kind == "not_null":
        return f"count_if(`{column}` IS NULL)"
    if check.kind == "freshness":
        bound = as_of - timedelta(hours=check.settings["hours"])
        typed = bound_text(rows, column, bound)
        return f"CASE WHEN max(`{column}`) < {typed} THEN 1 ELSE 0 END"
    if check.kind == "deleted_fraction":
        share = f"avg(CASE WHEN `{column}` THEN 1.0D ELSE 0.0D END)"
        return f"CASE WHEN {share} > {check.settings['fraction']}D THEN 1 ELSE 0 END"
    raise ValueError(f"unknown check kind {check.kind!r}")


def _orphan_count(tables: Mapping[str, DataFrame], entry: Numbered) -> DataFrame:
    number, check = entry
    parent_table, parent_column = check.settings["parent"].split(".", 1)
    keys = orphan_keys(
        tables[check.table], check.columns[0], tables[parent_table], parent_column
    )
    return _measured(keys, {number: "coalesce(sum(orphans), 0)"})


_LABEL_SCHEMA = (
    "check_no int, checkpoint string, suite string, asset string, expectation string, "
    "column_name string, severity string, description string, settings string, error string"
)


def _labels(check: Check, checkpoint: str) -> tuple[str | None, ...]:
    asset = f"{checkpoint}.{check.table}"
    settings = json.dumps({"kind": check.kind, "columns": list(check.columns), **check.settings})
    return (checkpoint, asset, asset, check.expectation, check.column_name, check.severity,
            check.description, settings)


def _verdict_columns() -> list[Column]:
    """The log's columns. A check that raised shows its error as what it observed."""
    error = truncate_observed(F.col("error"))
    observed = F.col("observed").cast("string")
    values = {
        "success": F.expr(
            "CASE WHEN error IS NOT NULL THEN false "
            f"WHEN expectation = '{ROW_COUNT}' THEN observed >= 1 ELSE observed = 0 END"
        ),
        "observed_value": F.coalesce(observed, error),
        "details": F.to_json(
            F.struct("settings", observed.alias("observed"), error.alias("exception")),
            {"ignoreNullFields": "false"},
        ),
    }
    return [values.get(name, F.col(name)).alias(name) for name in RESULT_SCHEMA.names]


def error_text(error: Exception) -> str:
    """The first line of what went wrong: of the deepest cause, if a job failed."""
    text = str(error)
    if isinstance(error, Py4JJavaError):
        cause = error.java_exception
        while cause is not None:
            text = cause.getMessage() or text
            cause = cause.getCause()
    lines = [line.strip() for line in text.splitlines() if line.strip()]
    return lines[0] if lines else "the check raised without a message"


def suite_verdict(results: DataFrame) -> DataFrame:
    """Passed and total per checkpoint. Only a failed ``error`` check fails it;
    warnings are counted apart."""
    lost = ~F.col("success")
    warned = F.col("severity") == "warn"
    return (
        results.groupBy("checkpoint")
        .agg(
            F.count_if(F.col("success")).alias("passed"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(lost & ~warned).alias("errors"),
            F.count_if(lost & warned).alias("warnings"),
        )
        .withColumn("failed", F.col("errors") > 0)
    )
