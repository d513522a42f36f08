"""The incremental load as a stream, and whole runs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from entry_queries.inputs import table
from entry_queries.registry import query
from landfall.contract import Resource
from landfall.plans.warehouse import Warehouse
from landfall.session import scratch_folder
from landfall.streaming.upsert import landed_files, stream_upsert

EVENTS = Resource("events", ("event_id",))
SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string, sent int"
)
COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")

# Where the deliveries are cut, the first and last being open, and how much of the
# end of one is sent again.
CUTS = (None, datetime(2024, 1, 11), datetime(2024, 1, 21), None)
OVERLAP = timedelta(days=1)


def moment(value):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def deliveries(spark, sf_dir, resend=False):
    """Events in three deliveries. With ``resend`` each starts with the last day of the
    one before, corrected."""
    events = table(spark, sf_dir, "events")
    for sent, (start, end) in enumerate(zip(CUTS, CUTS[1:])):
        delivery = events.withColumn("sent", F.lit(sent))
        if start is not None:
            since = start - OVERLAP if resend else start
            again = F.col("ts") < moment(start)
            corrected = F.when(again, F.col("value") + 1).otherwise(F.col("value"))
            delivery = delivery.filter(F.col("ts") >= moment(since)).withColumn("value", corrected)
        if end is not None:
            delivery = delivery.filter(F.col("ts") < moment(end))
        yield delivery


def upsert(spark, base):
    """Start the stream over what has been delivered, and let it end."""
    warehouse = Warehouse(f"{base}/warehouse", "shop", buckets=8)
    stream_upsert(landed_files(spark, f"{base}/landed", SCHEMA), warehouse, EVENTS,
                  f"{base}/checkpoint", order_by="sent")
    return warehouse


def upsert_deliveries(spark, sf_dir, base, resend=False):
    """One batch, and so one load, per delivery."""
    for delivery in deliveries(spark, sf_dir, resend):
        delivery.write.mode("append").parquet(f"{base}/landed")
        warehouse = upsert(spark, base)
    return warehouse


def landed(spark, warehouse):
    loads = warehouse.ledger(spark).filter("state = 'committed'").select("load_id").distinct()
    return warehouse.read(spark, "events").select(*COLUMNS, F.lit(loads.count()).alias("loads"))


@query("stream_upsert", "SELECT *, 3 AS loads FROM events")
def stream_upsert_query(spark, sf_dir):
    base = scratch_folder(spark, "stream")
    return landed(spark, upsert_deliveries(spark, sf_dir, base))


@query("stream_replay_safe", "SELECT *, 3 AS loads FROM events")
def stream_replay_safe_query(spark, sf_dir):
    """The stream is started again over the same files, and a load that was already
    committed is delivered once more."""
    base = scratch_folder(spark, "replay")
    upsert_deliveries(spark, sf_dir, base)
    warehouse = upsert(spark, base)
    ledger = warehouse.ledger(spark).filter("state = 'committed'")
    done = ledger.agg(F.min("load_id")).first()[0]
    again = warehouse.read(spark, "events").withColumn("value", F.lit(-1.0))
    warehouse.land("events", again, ["event_id"], done)
    return landed(spark, warehouse)


@query("stream_late_overlap", """
SELECT event_id, ts, user_id, event_type, props, 3 AS loads,
       CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
              OR ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21'
            THEN value + 1 ELSE value END AS value
FROM events
""")
def stream_late_overlap_query(spark, sf_dir):
    base = scratch_folder(spark, "overlap")
    return landed(spark, upsert_deliveries(spark, sf_dir, base, resend=True))
