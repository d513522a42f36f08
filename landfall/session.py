"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on. Shuffle width is left to the
# cluster: adaptive execution coalesces small partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# What one shuffle task should have to hold.
TASK_BYTES = 128 * 2**20


def configure(spark: SparkSession, largest_input_bytes: int | None = None) -> SparkSession:
    """Pin the zone to UTC and switch adaptive execution on.

    Adaptive execution merges shuffle partitions that turn out small but does not
    add any, so it has to start with enough of them. Given the size of the largest
    input, uncompressed, the number is raised to fit; it is never lowered.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if largest_input_bytes is not None:
        wanted = -(-largest_input_bytes // TASK_BYTES)
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the cluster names.

    ``spark.checkpoint.dir`` must be reachable by every executor. Only a local
    session may go without it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="landfall-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
