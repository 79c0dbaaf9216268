"""Streaming queries: the event table read as a stream and drained once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.payload import with_json
from ..operators.errors import INVALID_JSON, mark
from ..session import scratch_path
from ..sinks.files import DATE_PARTITIONS, with_event_date
from ..sources.tables import table
from ..streaming.streams import dedup_stream, durable_subscription, land_split, land_stream, message_stream
from .registry import query
from .statequeries import DEDUP_SQL


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    rows = message_stream(spark, sf_dir, schema, name_filter="events.parquet", max_files=1)
    return rows.select(
        "event_id",
        "user_id",
        F.concat(F.lit("events."), "event_type").alias("subject"),
        F.col("ts").cast("timestamp").alias("at"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"),
        "value",
        "props",
    )


@query(
    "stream_land",
    """
SELECT year(ts) AS "year", month(ts) AS "month", day(ts) AS "day", count(*) AS n_events
FROM events WHERE value >= 10 GROUP BY 1, 2, 3
""",
)
def stream_land(spark, sf_dir):
    """Stream → filter → date-partitioned files, exactly once; read back and counted."""
    home = scratch_path(spark, "stream-land")
    kept = with_event_date(_event_stream(spark, sf_dir).where(F.col("value") >= 10))
    land_stream(
        kept, f"{home}/data", f"{home}/checkpoint", partition_by=list(DATE_PARTITIONS)
    ).awaitTermination()
    landed = spark.read.parquet(f"{home}/data")
    return landed.groupBy(*[F.col(p).cast("bigint").alias(p) for p in DATE_PARTITIONS]).agg(
        F.count(F.lit(1)).alias("n_events")
    )


@query(
    "stream_subscribe",
    "SELECT event_id, 'events.' || event_type AS subject FROM events WHERE event_type = 'click'",
)
def stream_subscribe(spark, sf_dir):
    """A durable subscription drained twice: the second run finds nothing new."""
    home = scratch_path(spark, "stream-subscribe")
    for _ in range(2):
        mine, checkpoint = durable_subscription(
            _event_stream(spark, sf_dir), "events.click", "click-reader", home
        )
        land_stream(mine.select("event_id", "subject"), f"{home}/data", checkpoint).awaitTermination()
    return spark.read.parquet(f"{home}/data")


@query("stream_distinct", "SELECT DISTINCT user_id, 'events.' || event_type AS subject FROM events")
def stream_distinct(spark, sf_dir):
    """Message ids kept once within a window longer than the table's span."""
    home = scratch_path(spark, "stream-distinct")
    named = _event_stream(spark, sf_dir).select("event_id", "user_id", "subject", "at", F.concat_ws(".", "user_id", "subject").alias("id"))
    once = dedup_stream(named, "id", "at", "365d", tie="event_id").select("user_id", "subject")
    land_stream(once, f"{home}/data", f"{home}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(f"{home}/data")


@query("stream_dedup", DEDUP_SQL)
def stream_dedup(spark, sf_dir):
    """A three-day window over three batches in time order: the rows a batch run accepts."""
    home = scratch_path(spark, "stream-dedup")
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("at"), F.max("at")).first()
    third = (last - first) / 3
    for part in range(3):
        begin, end = F.lit(first + part * third), F.lit(first + (part + 1) * third)
        later = F.col("at") >= begin if part else F.lit(True)
        earlier = F.col("at") < end if part < 2 else F.lit(True)
        events.where(later & earlier).drop("ts").write.mode("append").parquet(f"{home}/inbox")
        stream = message_stream(spark, f"{home}/inbox", events.drop("ts").schema)
        named = stream.select("event_id", "user_id", "event_type", "at", F.concat_ws(".", "user_id", "event_type").alias("id"))
        once = dedup_stream(named, "id", "at", "3d", tie="event_id").select("event_id", "user_id", "event_type")
        land_stream(once, f"{home}/data", f"{home}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(f"{home}/data")


@query(
    "stream_errors",
    """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'InvalidJson' END AS error,
       CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events
""",
)
def stream_errors(spark, sf_dir):
    """Good and bad rows of a stream land in two tables."""
    home = scratch_path(spark, "stream-errors")
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    rows = with_json(_event_stream(spark, sf_dir), "v", text)
    marked = mark(
        rows.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.col("v").isNull().alias("bad")),
        F.when(F.col("bad"), F.lit(INVALID_JSON)),
    ).drop("bad")
    land_split(marked, f"{home}/good", f"{home}/errors", f"{home}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{home}/good").select("event_id", "k", F.lit(None).cast("string").alias("error"))
    failed = spark.read.parquet(f"{home}/errors").select("event_id", "k", F.col("_error").alias("error"))
    return good.unionByName(failed)
