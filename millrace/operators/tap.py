"""Watch events pass by without changing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import to_json_text, with_json_or_string, with_reparsed

# Log levels.
LEVELS = ("trace", "debug", "info", "warn", "error")


def with_parsed_payload(events: DataFrame, name: str = "parsed") -> DataFrame:
    """Add what a structured log shows: a JSON *string* payload is parsed again."""
    kind = events.schema["data"].dataType
    if isinstance(kind, T.VariantType):
        return with_reparsed(events, name, "data")
    if isinstance(kind, T.StringType):
        return with_json_or_string(events, name, F.col("data"))
    return events.withColumn(name, F.col("data"))


def tap(
    events: DataFrame, level: str = "info", name: str = "tap", *, structured: bool = False
) -> tuple[DataFrame, Observation | str]:
    """Pass events through unchanged and count them on the way.

    With ``structured`` the observation also holds one event as JSON, payload parsed if
    it is text: the one with the smallest hash, so that one row at most is kept.

    Counting is an observed metric of the same job; no extra pass, no rows on
    the driver.  If Spark itself reads this step twice, as sampling for a later
    global sort does, the metric counts both readings.  On a stream the
    metric is found under ``name`` in the query's progress.
    """
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    seen = name if events.isStreaming else Observation(name)
    metrics = [
        F.count(F.lit(1)).alias("events"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    ]
    if not structured:
        return events.observe(seen, *metrics), seen
    shown = with_parsed_payload(events, "_seen")
    payload = to_json_text(F.col("_seen"), shown.schema["_seen"].dataType)
    envelope = F.to_json(F.struct("subject", "id", "timestamp", "task_id", "task_type"), {"ignoreNullFields": "false"})
    example = F.concat(F.substring(envelope, F.lit(1), F.length(envelope) - 1), F.lit(',"data":'), payload, F.lit("}"))
    metrics.append(F.min(F.struct(F.xxhash64("subject", "id", "timestamp").alias("hash"), example.alias("event"))).alias("example"))
    return shown.observe(seen, *metrics).drop("_seen"), seen
