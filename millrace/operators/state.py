"""Key-value state as an append-only log table: key, value, revision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Fixed value: revisions kept per key.
HISTORY = 10

STATE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.StringType(), True),
        T.StructField("revision", T.LongType(), False),
    ]
)


def state_latest(log: DataFrame, key: str = "key", value: str = "value", revision: str = "revision") -> DataFrame:
    """Last value per key.  Combines map-side, so a hot key costs one row per task."""
    return log.groupBy(F.col(key).alias("key")).agg(
        F.max_by(value, revision).alias("value"), F.max(revision).alias("revision")
    )


def state_history(
    log: DataFrame, key: str = "key", revision: str = "revision", keep: int = HISTORY
) -> DataFrame:
    """The newest ``keep`` revisions per key.

    The rank filter is applied in the map tasks too (window group limit), so a key
    holding most of the log sends at most ``keep`` rows per task to the shuffle.
    """
    newest = Window.partitionBy(key).orderBy(F.col(revision).desc())
    return log.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= keep)


def state_put(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """Append entries (key, value, revision) to a state table."""
    entries.select("key", "value", "revision").write.mode("append").parquet(path)


def state_get(log: DataFrame, key: str) -> str:
    """Current value of one key; an absent key is an error."""
    row = (
        log.where(F.col("key") == key)
        .agg(F.max_by("value", "revision").alias("value"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    if row["n"] == 0:
        raise KeyError(key)
    return row["value"]


def last_run_key(flow: Column | str, task_type: Column | str, task: Column | str) -> Column:
    """``{flow}.{task_type}.{task}.last_run``"""
    parts = [F.lit(p) if isinstance(p, str) else p for p in (flow, task_type, task)]
    return F.concat_ws(".", *parts, F.lit("last_run"))
