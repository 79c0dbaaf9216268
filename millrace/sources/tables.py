"""The given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.envelope import micros, to_events
from ..session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its ``props`` number as a column ``k``."""
    rows = table(spark, sf_dir, "events")
    return rows.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def event_envelope(spark: SparkSession, sf_dir: str, data: Column | None = None) -> DataFrame:
    """``events`` in the envelope, subject ``events.<event_type>``, typed payload."""
    rows = event_rows(spark, sf_dir)
    payload = F.struct("event_id", "user_id", "event_type", "value", "k") if data is None else data
    return to_events(
        rows,
        data=payload,
        subject=F.concat(F.lit("events."), F.col("event_type")),
        id=F.col("event_id"),
        timestamp=micros(rows, "ts"),
        task_type="table_reader",
    )
