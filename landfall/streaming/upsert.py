"""Incremental upserts as a stream of landed files.

Every micro-batch is one load. The stream's checkpoint is the cursor; the
warehouse's ledger makes a batch that is delivered twice land once. There is no
event-time watermark: a lookback exists so that late rows are merged, not lost.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from landfall.contract import Resource
from landfall.operators.shape import landed_key, landed_rows
from landfall.plans.warehouse import Warehouse


def landed_files(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None,
    form: str = "parquet",
) -> DataFrame:
    """Files of a folder as a stream, oldest first."""
    reader = spark.readStream.format(form).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_upsert(
    records: DataFrame,
    warehouse: Warehouse,
    resource: Resource,
    checkpoint: str,
    order_by: str | None = None,
) -> StreamingQuery:
    """Merge everything that has landed so far, then stop.

    ``order_by`` tells re-sent rows of one batch apart; the last one wins.
    """
    keys = landed_key(resource)
    # What an earlier run left half done, once per start: a batch that fails ends this one.
    warehouse.recover(records.sparkSession)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load_id = f"{_stream_id(spark, checkpoint)}-{batch_id:08d}"
        rows = landed_rows(batch, resource, load_id)
        warehouse.land(
            resource.name, rows, keys, load_id, resource.write_disposition, order_by
        )

    query = (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in the checkpoint: the same after a restart, another one
    for a stream that starts over, so batch numbers are never confused."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
