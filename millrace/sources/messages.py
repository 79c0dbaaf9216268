"""Message tables: subject subscriptions, cursors and payload decoding."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import with_json
from ..functions.subjects import Shape, subject_matches
from ..operators import errors
from ..operators.lookup import HELD_ROWS
from ..session import path_exists

log = logging.getLogger(__name__)

# Fixed value: header that carries the message id.
MESSAGE_ID_HEADER = "Nats-Msg-Id"


def subscribe(messages: DataFrame, pattern: str) -> DataFrame:
    """Messages whose subject matches; works on batch and streaming tables."""
    return messages.where(subject_matches(F.col("subject"), pattern))


def subscribe_many(messages: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Messages of all subscriptions (durable name → pattern), read once: a message comes
    once for every name whose pattern matches, with that ``durable_name``.

    Patterns of the same shape (number of tokens, places of wildcards) differ only in
    their fixed tokens, so a message is looked up once per shape, by those tokens of its
    subject, however many patterns there are.  Works on batch and streaming tables.
    """
    spark = messages.sparkSession
    shapes = sorted({Shape.of(pattern) for pattern in patterns.values()})
    number = {shape: n for n, shape in enumerate(shapes)}
    rows = [(number[shape := Shape.of(pattern)], shape.pattern_key(pattern), name) for name, pattern in patterns.items()]
    routes = spark.createDataFrame(rows, "_shape int, _key string, durable_name string")
    if len(rows) <= HELD_ROWS:
        routes = F.broadcast(routes)
    tokens = F.split("subject", r"\.", -1)
    keys = [F.struct(F.lit(n).alias("shape"), shape.subject_key(tokens).alias("key")) for shape, n in number.items()]
    if not keys:
        return messages.withColumn("durable_name", F.lit(None).cast("string")).limit(0)
    asked = messages.withColumn("_asked", F.explode(F.filter(F.array(*keys), lambda k: k["key"].isNotNull())))
    met = asked.join(routes, (F.col("_asked.shape") == F.col("_shape")) & (F.col("_asked.key") == F.col("_key")))
    return met.drop("_asked", "_shape", "_key")


def replay_from(
    messages: DataFrame,
    cursors: DataFrame,
    name: str,
    *,
    sequence: str = "sequence",
    enabled: bool = True,
    managed: bool = False,
) -> DataFrame:
    """Messages after the stored cursor of ``name``.

    The cursor is one value, read first so the comparison is a literal the file
    scan can skip on.  Without a stored cursor everything is replayed.
    """
    if not enabled or managed:
        return messages
    row = cursors.where(F.col("name") == name).agg(F.max("replay_id").alias("at")).first()
    if row["at"] is None:
        log.warning("no cursor stored for %s, starting from the beginning", name)
        return messages
    return messages.where(F.col(sequence) > row["at"])


def stored_cursor(spark: SparkSession, path: str, name: str) -> int | None:
    """The last replay id committed under a name, None without one."""
    place = f"{path.rstrip('/')}/{name}"
    if not path_exists(spark, place):
        return None
    rows = spark.read.schema("replay_id long").parquet(place)
    return rows.agg(F.max("replay_id")).first()[0]


def commit_cursor(spark: SparkSession, path: str, name: str, replay_id: int, commit: str) -> None:
    """Record a cursor under a name; the same ``commit`` again replaces its own."""
    row = spark.createDataFrame([(replay_id,)], "replay_id long")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}/commit={commit}")


def advance_cursor(messages: DataFrame, name: str, *, sequence: str = "sequence") -> DataFrame:
    """Cursor row (name, replay_id) after these messages."""
    return messages.agg(F.max(sequence).alias("replay_id")).select(F.lit(name).alias("name"), "replay_id")


def decode_payload(messages: DataFrame, column: str = "payload", headers: str | None = "headers") -> DataFrame:
    """Message bytes → VARIANT plus ``payload_kind``; id from the message-id header.

    Bytes that are not JSON keep their row, marked for the error table.
    """
    text = F.col(column).cast("string")
    readable = F.when(F.is_valid_utf8(text), text)
    out = with_json(messages, "data", readable)
    if headers is not None:
        out = out.withColumn("id", F.element_at(F.col(headers), F.lit(MESSAGE_ID_HEADER)))
    out = out.withColumn(
        "payload_kind", F.when(F.col("data").isNotNull(), F.lit("json")).otherwise(F.lit("undecoded"))
    )
    return errors.mark(
        out, F.when(F.col("payload_kind") == "undecoded", F.lit(errors.INVALID_JSON))
    )
