"""The record a warehouse keeps of itself: verdicts, runs, counts, schema changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from landfall.operators.shape import LOAD_ID

# Column order of the two append-only logs.
RESULT_COLUMNS = (
    "checkpoint", "suite", "asset", "expectation", "column_name", "success",
    "severity", "description", "observed_value", "details",
    "dag_id", "dag_run_id", "task_id",
)
RUN_COLUMNS = (
    "dag_id", "dag_run_id", "task_id", "status", "started_at", "elapsed_seconds",
    "mode", "destination", "resources", "load_ids", "rows_this_run",
    "warehouse_counts", "requests_by_family",
)

# What the log says of rows written before a column existed.
RESULT_DEFAULTS = {"severity": ("string", "error"), "description": ("string", None)}

# What identifies one check across runs.
CHECK_IDENTITY = ("asset", "expectation", "column_name", "description")

# Tables the library keeps for itself start with an underscore.
INTERNAL_PREFIX = "_"


def latest_verdict(log: DataFrame, order: Sequence[str] = ("validated_at",)) -> DataFrame:
    """The newest row per check, the other columns breaking ties. Map tasks each
    keep one row per check."""
    others = [name for name in log.columns if name not in (*CHECK_IDENTITY, *order)]
    newest = Window.partitionBy(*CHECK_IDENTITY).orderBy(
        *[F.col(name).desc_nulls_last() for name in order],
        *[F.col(name).asc_nulls_first() for name in others],
    )
    return (
        log.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def failures_for_asset(log: DataFrame, asset: str) -> DataFrame:
    """Failures of one table, newest first."""
    return log.filter((F.col("asset") == asset) & ~F.col("success")).orderBy(
        F.col("validated_at").desc(), *CHECK_IDENTITY
    )


def first_failure(
    log: DataFrame,
    tiebreak: Sequence[str] = (),
    check: Sequence[str] = CHECK_IDENTITY,
    slice_unit: str = "hour",
) -> DataFrame:
    """Every turn from passing to failing, per check; the newest one answers
    "since when".

    A check may hold much of the log, so its history is cut into time slices:
    neighbours are compared inside a slice, and only the first and last row of
    each slice are compared across slices. Both read one shuffle.
    """
    order = [F.col(name) for name in ("validated_at", *tiebreak)]
    inside = Window.partitionBy(*check, "_slice").orderBy(*order)
    rows = log.withColumn("_slice", F.date_trunc(slice_unit, "validated_at")).withColumns({
        "_before": F.lag("success").over(inside),
        "_place": F.row_number().over(inside),
        "_followed": F.lead(F.lit(True), 1, False).over(inside),
    })
    first = F.col("_place") == 1
    across = Window.partitionBy(*check).orderBy(*order)
    edges = rows.filter(first | ~F.col("_followed")).withColumn(
        "_before", F.lag("success").over(across)
    )
    fell = ~F.col("success") & F.col("_before")
    return (
        rows.filter(~first & fell).select(*log.columns)
        .unionByName(edges.filter(first & fell).select(*log.columns))
    )


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; null where the table does not exist."""
    if not tables:
        return spark.createDataFrame([], "table_name string, total bigint")
    return reduce(
        DataFrame.unionByName,
        [
            (rows.agg(F.count(F.lit(1)).alias("total")) if rows is not None
             else spark.range(1).select(F.lit(None).cast("bigint").alias("total")))
            .select(F.lit(name).alias("table_name"), "total")
            for name, rows in tables.items()
        ],
    )


def rows_this_run(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], load_ids: Sequence[str]
) -> DataFrame:
    """Rows each table got from this run, over all its loads."""
    landed = [
        rows.filter(F.col(LOAD_ID).isin(*load_ids))
        .agg(F.count(F.lit(1)).alias("rows_this_run"))
        .select(F.lit(name).alias("table_name"), "rows_this_run")
        for name, rows in tables.items()
        if rows is not None
    ]
    if not landed or not load_ids:
        return spark.createDataFrame([], "table_name string, rows_this_run bigint")
    return reduce(DataFrame.unionByName, landed).filter(F.col("rows_this_run") > 0)


def run_summary(counts: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows of this run beside totals, by table. A total is null for a missing
    table; tables the library keeps for itself are left out."""
    return (
        counts.join(landed, "table_name", "full")
        .filter(~F.col("table_name").startswith(INTERNAL_PREFIX))
        .select(
            "table_name",
            F.coalesce("rows_this_run", F.lit(0)).alias("rows_this_run"),
            "total",
        )
        .orderBy("table_name")
    )


def record_run(summaries: DataFrame) -> DataFrame:
    """Run summaries as log rows: lists and maps become JSON text (empty when
    absent), and a start time that is no time becomes null, not a lost record."""
    given = {field.name: field.dataType for field in summaries.schema.fields}
    empty = {"resources": "[]", "load_ids": "[]", "rows_this_run": "{}",
             "warehouse_counts": "{}", "requests_by_family": "{}"}
    columns = []
    for name in RUN_COLUMNS:
        value = F.col(name) if name in given else F.lit(None).cast("string")
        if name in empty:
            text = (
                value if isinstance(given.get(name), (T.StringType, type(None)))
                else F.to_json(value, {"ignoreNullFields": "false"})
            )
            value = F.coalesce(text, F.lit(empty[name]))
        elif name == "started_at" and isinstance(given.get(name), T.StringType):
            value = value.try_cast("timestamp")
        elif name == "elapsed_seconds":
            value = value.cast("double")
        columns.append(value.alias(name))
    return summaries.select(*columns)


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schemas as data: one row per table and column."""
    return spark.createDataFrame(
        [
            (name, field.name, field.dataType.simpleString())
            for name, rows in tables.items()
            for field in rows.schema.fields
        ],
        "table_name string, column_name string, data_type string",
    ).coalesce(1)


def observed_schema(records: DataFrame, table: str, record: str = "record") -> DataFrame:
    """The same, as records themselves show it: every field and type that occurs in
    a column of JSON objects (VARIANT), null values telling nothing."""
    fields = records.select(
        F.explode(F.expr(f"map_entries(CAST({record} AS map<string, variant>))")).alias("_field")
    )
    seen = fields.select(
        F.lit(table).alias("table_name"),
        F.col("_field.key").alias("column_name"),
        F.schema_of_variant("_field.value").alias("data_type"),
    )
    return seen.filter(F.col("data_type") != "VOID").distinct()


def schema_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Columns that are new, or have a new type, since the previous schema."""
    return current.join(previous, ["table_name", "column_name", "data_type"], "left_anti")
