"""What the operators share on the Spark side: reading, row identity, written steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import scratch_folder

# Arrow batches stay small, since texts may be very long.
BATCH_ROWS, BATCH_BYTES = "512", "8388608"


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, by rows and by bytes."""
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under names of this library, so no other column can clash."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("_id"),
                     F.col(text_col).cast("string").alias("_text"))


def which_text() -> Column:
    """Tells apart rows that share an id but not their text."""
    return F.coalesce(F.hash("_text"), F.lit(0))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, for every later reader."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Steps:
    """Written tables of one job, which it removes as it leaves them behind."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[tuple[DataFrame, str]] = []

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        folder = scratch_folder(self.spark, purpose)
        df.write.parquet(folder)
        out = self.spark.read.schema(df.schema).parquet(folder)
        self.folders.append((out, folder))
        return out

    def remove(self, *tables: DataFrame) -> None:
        """Remove tables that no later step and no result reads."""
        for table in tables:
            for step in [s for s in self.folders if s[0] is table]:
                self.folders.remove(step)
                remove_folder(self.spark, step[1])


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder that nothing reads any more, through Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filter_by_text(df: DataFrame, text_col: str, keep: Callable[[list[bytes | None]], list[bool]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text is to be kept; nothing is shuffled."""
    small_batches(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else None for x in batch.column(at)]
            yield batch.filter(pa.array(keep(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)
