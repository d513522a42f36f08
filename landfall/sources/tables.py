"""Tables as inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table_scan(spark: SparkSession, dataset: str, table: str) -> DataFrame:
    return spark.table(f"{dataset}.{table}")


def present_tables(spark: SparkSession, dataset: str) -> set[str]:
    """The tables of a database; none if it does not exist."""
    if not spark.catalog.databaseExists(dataset):
        return set()
    return {table.name for table in spark.catalog.listTables(dataset) if not table.isTemporary}


def ensure_database(spark: SparkSession, dataset: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")


def scan_projected(
    df: DataFrame, fields: Sequence[str], required: Sequence[str] = ()
) -> DataFrame:
    """The requested fields the source has. A missing one costs its column, but a
    missing key or cursor is an error, since nothing downstream would notice."""
    lost = [name for name in required if name not in df.columns or name not in fields]
    if lost:
        raise ValueError(f"the projection loses {', '.join(lost)}")
    return df.select(*[name for name in fields if name in df.columns])
