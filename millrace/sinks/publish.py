"""Publishing to a message table, with acknowledgements."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import duration_micros
from ..functions.template import render
from ..operators.dedup import mark_duplicates
from ..operators.lookup import HELD_ROWS
from ..operators.sequence import assign_sequence
from ..session import materialize, path_exists, subfolders


def publish(
    events: DataFrame,
    stream: str,
    subject_template: str,
    *,
    order_by: list[str] | None = None,
    tie: Column | None = None,
    domain: str | None = None,
    duplicate_window: str | int | None = None,
    start: int | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Number events for a stream: subject rendered per row, id as message id.

    Stored messages get gap-free sequences in time order.  With a duplicate
    window, a repeated id is acknowledged as ``duplicate`` with the sequence of the
    message it repeats, and is not stored again.  ``stored`` are messages the stream
    already holds (id, timestamp, sequence), which count as originals.  Numbers begin
    with ``start``, or after the stored messages.  Returns the message rows with their
    ack columns.
    """
    rendered = events.withColumn("subject", render(subject_template, events))
    order = order_by or ["timestamp", "id"]
    if start is None:
        start = 1 if stored is None else (stored.agg(F.max("sequence")).first()[0] or 0) + 1
    if duplicate_window is None:
        out = assign_sequence(rendered.withColumn("duplicate", F.lit(False)), order, start=start)
    else:
        length = duration_micros(duplicate_window) if isinstance(duplicate_window, str) else duplicate_window
        if tie is None:
            # Equal rows must stay apart: number them once and store the numbers.
            keyed = materialize(rendered.withColumn("_tie", F.monotonically_increasing_id()), "publish")
        else:
            keyed = rendered.withColumn("_tie", tie)
        if stored is not None:
            keyed, repeated = _split_repeats(keyed, stored, length)
        marked = mark_duplicates(keyed, "id", "timestamp", "_tie", length).drop("_tie")
        placed = assign_sequence(marked, order, start=start, skip="duplicate")
        numbered = placed.where(~F.col("duplicate"))
        repeats = placed.where("duplicate").drop("sequence")
        out = numbered.unionByName(_with_original(repeats, numbered, length))
        if stored is not None:
            out = out.unionByName(repeated.drop("_tie").withColumn("duplicate", F.lit(True)))
    return out.withColumns({"stream": F.lit(stream), "domain": F.lit(domain).cast("string")})


def _split_repeats(events: DataFrame, stored: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(events no stored message precedes within the window, repeats with its sequence)."""
    earliest = events.agg(F.min("timestamp")).scalar()
    recent = stored.where(F.col("timestamp") > earliest - window)
    repeats = _with_original(events, recent, window)
    fresh = events.join(repeats.select(F.col("_tie").alias("_repeat")), F.col("_tie") == F.col("_repeat"), "left_anti")
    return fresh, repeats


def _with_original(repeats: DataFrame, numbered: DataFrame, window: int) -> DataFrame:
    """Give each repeat the sequence of the message it repeats.

    The original lies less than one window earlier.  Time slices one window long
    hold at most one original per id, so an equality join on (id, slice) with each
    original in its own and the next slice finds it with at most two candidates.
    """
    time_slice = F.floor(F.col("timestamp") / window)
    originals = numbered.where(F.col("id").isNotNull()).select(
        F.col("id").alias("_id"),
        F.col("timestamp").alias("_at"),
        "sequence",
        F.explode(F.array(time_slice, time_slice + 1)).alias("_slice"),
    )
    match = [
        F.col("id") == F.col("_id"),
        time_slice == F.col("_slice"),
        F.col("timestamp") >= F.col("_at"),
        F.col("timestamp") < F.col("_at") + window,
    ]
    return repeats.join(originals, match).select(*repeats.columns, "sequence")


LEDGER = "_ledger"


@dataclass(frozen=True)
class Published:
    """What the ledger of a message table says about a batch."""

    number: int
    batch: str
    last: int


def ledger(spark: SparkSession, path: str) -> list[Published]:
    """The committed batches in their order, from the names of the ledger's folders: no
    file is read."""
    found = []
    for name in subfolders(spark, f"{path}/{LEDGER}"):
        number, last, batch = name.split("-", 2)
        if path_exists(spark, f"{path}/{LEDGER}/{name}/_SUCCESS"):
            found.append(Published(int(number), batch, int(last)))
    return sorted(found, key=lambda entry: entry.number)


def _folder(batch: str) -> str:
    return f"batch=b-{batch}"


def read_messages(spark: SparkSession, path: str) -> DataFrame | None:
    """The messages of the committed batches of a table, None before the first one."""
    committed = ledger(spark, path)
    if not committed:
        return None
    names = spark.createDataFrame([(f"b-{entry.batch}",) for entry in committed], "batch string")
    names = F.broadcast(names) if len(committed) <= HELD_ROWS else names
    return spark.read.parquet(path).join(names, "batch", "left_semi").drop("batch")


def publish_batch(events: DataFrame, path: str, stream: str, subject_template: str, *, batch: str | None = None, **options) -> DataFrame:
    """Publish a batch into the message table at ``path`` once; its ack rows.

    Sequences go on after the last batch of the ledger, whose name says where it ended:
    the messages are not searched for the largest one.  Messages and repeats are written
    under the batch's own name, then the ledger gets its entry.  A batch that the ledger
    has is not numbered again: its acks are read back.  One that failed before its entry
    is numbered and written anew, in its own place.

    Entries start with ``{number}-{last sequence}-{batch}``.  One writer at a time.
    """
    spark, batch = events.sparkSession, batch or uuid.uuid4().hex
    committed = ledger(spark, path)
    messages_at, repeats_at = f"{path}/{_folder(batch)}", f"{path}/_repeats/{_folder(batch)}"
    if not any(entry.batch == batch for entry in committed):
        last = committed[-1].last if committed else 0
        stored = read_messages(spark, path) if options.get("duplicate_window") is not None else None
        rows = materialize(publish(events, stream, subject_template, start=last + 1, stored=stored, **options), "publish-batch")
        kept = rows.where(~F.col("duplicate"))
        kept.sortWithinPartitions("subject", "sequence").drop("duplicate").write.mode("overwrite").parquet(messages_at)
        rows.where("duplicate").drop("duplicate").write.mode("overwrite").parquet(repeats_at)
        end = kept.agg(F.max("sequence")).first()[0] or last
        number = committed[-1].number + 1 if committed else 0
        entry = spark.createDataFrame([(stream, batch, last + 1, end)], "stream string, batch string, first long, last long")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/{LEDGER}/{number:012d}-{end}-{batch}")
    messages = spark.read.parquet(messages_at).withColumn("duplicate", F.lit(False))
    return messages.unionByName(spark.read.parquet(repeats_at).withColumn("duplicate", F.lit(True)))


def acks(messages: DataFrame) -> DataFrame:
    """Acknowledgement columns only."""
    return messages.select("stream", "sequence", "domain", "duplicate")


def append_messages(messages: DataFrame, path: str) -> None:
    """Append the stored (not duplicate) messages to a plain message table.

    Rows are sorted by subject within each file, without a shuffle, so that a
    subscription's equality or prefix test skips the row groups of other subjects.
    """
    kept = messages.where(~F.col("duplicate")).drop("duplicate")
    kept.sortWithinPartitions("subject", "sequence").write.mode("append").parquet(path)
