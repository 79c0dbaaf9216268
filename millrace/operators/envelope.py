"""The event envelope: payload plus routing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Envelope columns, in order.
COLUMNS = ("data", "subject", "id", "timestamp", "task_id", "task_type")
ERROR = "_error"


def micros(df: DataFrame, column: str) -> Column:
    """A time column as microseconds since the epoch (UTC session zone)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.LongType):
        return F.col(column)
    return F.unix_micros(F.col(column).cast("timestamp"))


def to_events(
    df: DataFrame,
    *,
    data: Column | None,
    subject: Column | str | None,
    task_type: str | None,
    id: Column | None = None,
    timestamp: Column | None = None,
    task_id: int | None = 0,
) -> DataFrame:
    """Wrap rows in the envelope.

    ``data``, ``subject``, ``task_id`` and ``task_type`` are required; leaving one
    out fails when the plan is built.  ``timestamp`` (µs) defaults to now.
    """
    required = {"data": data, "subject": subject, "task_id": task_id, "task_type": task_type}
    for name, value in required.items():
        if value is None:
            raise ValueError(f"Missing required attribute: {name}")
    return df.select(
        data.alias("data"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
        (F.lit(None) if id is None else id).cast("string").alias("id"),
        (F.unix_micros(F.current_timestamp()) if timestamp is None else timestamp)
        .cast("bigint")
        .alias("timestamp"),
        F.lit(task_id).cast("int").alias("task_id"),
        F.lit(task_type).alias("task_type"),
    )


def restamp(
    events: DataFrame,
    *,
    task_id: int,
    task_type: str,
    subject: str | None = None,
    drop_id: bool = False,
    processed_at: bool = False,
) -> DataFrame:
    """Envelope changes a task makes: own id and type, maybe its name as subject.

    The source time is kept so results are repeatable; ``processed_at`` adds the
    processing time in its own column.
    """
    out = events.withColumn("task_id", F.lit(task_id).cast("int")).withColumn(
        "task_type", F.lit(task_type)
    )
    if subject is not None:
        out = out.withColumn("subject", F.lit(subject))
    if drop_id:
        out = out.withColumn("id", F.lit(None).cast("string"))
    if processed_at:
        out = out.withColumn("processed_at", F.unix_micros(F.current_timestamp()))
    return out


def event_key() -> Column:
    """``subject.id``, or ``subject.timestamp`` for an event without id."""
    return F.concat_ws(
        ".", F.col("subject"), F.coalesce(F.col("id"), F.col("timestamp").cast("string"))
    )
