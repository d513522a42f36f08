"""Which stretches of time a resource has been read for, whatever order they were asked in.

Every bounded read is an interval with the newest moment found in it. Intervals that overlap
or touch are one island; what is known without a gap ends where the island ends that
reaches back to the floor. A window that lands beyond a gap moves nothing until the gap is
filled, and then counts at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

RANGES_SCHEMA = (
    "source string, resource string, destination string, range_start timestamp, "
    "range_end timestamp, newest timestamp, load_id string, saved_at timestamp"
)


def islands(
    ranges: DataFrame, by: Sequence[str], start: str = "range_start", end: str = "range_end",
    newest: str = "newest",
) -> DataFrame:
    """Overlapping and touching intervals merged: ``by...``, the bounds, ``newest`` and how
    many ``pieces`` an island is made of.

    A null start reaches back to the beginning. An interval without an end, or that ends
    before it starts, covers nothing. There is one interval per run, so those of one
    resource are few and each resource is merged by itself.
    """
    usable = ranges.filter(
        F.col(end).isNotNull() & (F.col(start).isNull() | (F.col(start) <= F.col(end))))
    order = Window.partitionBy(*by).orderBy(F.col(start).asc_nulls_first(), F.col(end))
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col(start) > before).cast("int"), F.lit(0))
    numbered = usable.withColumn("_opens", opens).withColumn(
        "_island", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_island").agg(
        F.min_by(start, F.coalesce(F.unix_micros(F.col(start).cast("timestamp")), F.lit(-(2**63)))).alias(start),
        F.max(end).alias(end), F.max(newest).alias(newest), F.count(F.lit(1)).alias("pieces"),
    ).drop("_island")


def covered_until(
    ranges: DataFrame, by: Sequence[str], floor: datetime
) -> DataFrame:
    """Per resource ``newest``: how far it is known without a gap from ``floor`` on.

    All before the floor counts as known. A resource without an island that reaches the
    floor has no row.
    """
    moment = F.lit(floor.isoformat(sep=" ")).cast("timestamp")
    known = ranges.select(*by).distinct().select(
        *by, F.lit(None).cast("timestamp").alias("range_start"), moment.alias("range_end"),
        moment.alias("newest"))
    every = ranges.select(*by, "range_start", "range_end", "newest").unionByName(known)
    return islands(every, by).filter(F.col("range_start").isNull()).select(*by, "newest")
