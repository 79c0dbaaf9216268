"""Message streams: durable subscriptions, pacing, landing, deduplication, metrics."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..functions.durations import duration_micros
from ..operators import errors
from ..session import path_exists
from ..sources.messages import subscribe

# Groups that the ids of a deduplicated stream are dealt to.
ID_BUCKETS = 1024


def message_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    format: str = "parquet",
    name_filter: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    delete_after_read: bool = False,
    wholetext: bool = False,
) -> DataFrame:
    """A folder of message files as a stream.

    ``max_files``/``max_bytes`` bound one fetch.  ``delete_after_read`` removes a
    file once a later batch has committed, so the newest file stays until then.
    """
    reader = spark.readStream.format(format).schema(schema)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if delete_after_read:
        reader = reader.option("cleanSource", "delete")
    if wholetext:
        reader = reader.option("wholetext", True)
    return reader.load(path)


def durable_subscription(
    messages: DataFrame, pattern: str, durable_name: str, root: str
) -> tuple[DataFrame, str]:
    """(filtered stream, checkpoint path) of a named subscription.

    The name resumes where it stopped.  Its pattern is stored beside the
    checkpoint; the same name with another pattern is an error.
    """
    home = f"{root.rstrip('/')}/{durable_name}"
    bind_filter(messages.sparkSession, home, pattern)
    return subscribe(messages, pattern), f"{home}/checkpoint"


def bind_filter(spark: SparkSession, home: str, pattern: str) -> None:
    """Keep a durable name's pattern in its folder; another one later is an error."""
    stored = _stored_pattern(spark, f"{home}/_filter")
    if stored is None:
        spark.createDataFrame([(pattern,)], "value string").coalesce(1).write.text(f"{home}/_filter")
    elif stored != pattern:
        name = home.rpartition("/")[2]
        raise ValueError(f"durable name {name!r} is bound to {stored!r}, not {pattern!r}")


def _stored_pattern(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    row = spark.read.text(path).first()
    return None if row is None else row["value"]


def _trigger(delay: str | None, once: bool) -> dict:
    if once:
        return {"availableNow": True}
    if delay is None:
        return {}
    return {"processingTime": f"{max(1, duration_micros(delay) // 1000)} milliseconds"}


def land_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    format: str = "parquet",
    partition_by: list[str] | None = None,
    delay: str | None = None,
    once: bool = True,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to partitioned files, exactly once, from a checkpoint.

    ``once`` drains what is there and stops; otherwise ``delay`` spaces the fetches.
    ``state_partitions`` sets how many state stores a stateful stream starts with; a
    checkpoint keeps that number for good, so size it for the cluster.
    """
    writer = stream.writeStream.format(format).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(**_trigger(delay, once))
    if state_partitions is None:
        return writer.start(path)
    # A query copies the session's options when it starts.
    conf, option = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    usual = conf.get(option)
    conf.set(option, state_partitions)
    try:
        return writer.start(path)
    finally:
        conf.set(option, usual)


def land_split(
    stream: DataFrame, good_path: str, error_path: str, checkpoint: str, *, once: bool = True, delay: str | None = None
) -> StreamingQuery:
    """Good rows and error rows to two tables; one pass over each batch's input.

    Each batch writes into a folder named by its number, so a repeated batch
    replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            good, failed = errors.split_errors(held)
            good.write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            failed.write.mode("overwrite").parquet(f"{error_path}/batch={number}")
        finally:
            held.unpersist()

    return for_each_batch(stream, write, checkpoint, once=once, delay=delay)


def for_each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    once: bool = True,
    delay: str | None = None,
) -> StreamingQuery:
    """Run a batch sink per fetch."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(delay, once))
        .start()
    )


def dedup_stream(
    stream: DataFrame, id: str, event_time: str, window: str, *, tie: str | None = None, late: str | None = None, buckets: int = ID_BUCKETS
) -> DataFrame:
    """Rows that do not repeat an id within ``window`` of its last *accepted* row.

    The rule of ``operators.dedup``, batch by batch: the state of an id is the time of its
    last accepted row, and it goes once the watermark, ``late`` (by default the window)
    behind the latest time, has passed the end of its window.  Within a batch rows are
    taken in the order of time and ``tie``.  Rows without an id are never duplicates and
    keep no state.

    Ids are dealt by their hash to ``buckets``, each one group with one state: a call of
    Python for each id would cost far more than its rows.  State that has passed goes when
    its bucket has rows again, or with the last of the bucket.  A checkpoint keeps the
    number of buckets for good.
    """
    length = duration_micros(window)
    delay = f"{duration_micros(late) // 1000 if late else length // 1000} milliseconds"
    marked = stream.withWatermark(event_time, delay)
    # Only the watermark column keeps its type; the rest crosses to Python as it is or,
    # where Python has no such type, as JSON text.
    variants = [f.name for f in stream.schema if isinstance(f.dataType, T.VariantType)]
    plain = marked.withColumns({name: F.to_json(name) for name in variants}) if variants else marked
    # Python compares ids as texts, of other types as JSON.
    kind = stream.schema[id].dataType
    number = F.col(id) + F.lit(0).cast(kind) if isinstance(kind, T.FractionalType) else F.col(id)  # no -0.0
    text = F.col(id) if isinstance(kind, T.StringType) else F.to_json(F.struct(number.alias("id")))
    shaped = plain.withColumns({
        "_at": F.unix_micros(event_time),
        "_order": F.col(tie).cast("long") if tie else F.lit(0).cast("long"),
        "_key": F.when(F.col(id).isNotNull(), text),
        "_bucket": F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int"),
    })
    columns = shaped.columns

    def accept(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        passed = state.getCurrentWatermarkMs()
        ends = lambda last: -(-(last + length) // 1000)
        known = dict(zip(*state.get)) if state.exists else {}
        rows = pd.concat(list(frames), ignore_index=True)
        codes, ids = pd.factorize(rows["_key"])
        # Stable: rows of one id at one time and tie stay as they came.
        places = np.lexsort((rows["_order"].to_numpy(), rows["_at"].to_numpy(), codes))
        times = rows["_at"].to_numpy()[places].tolist()
        cuts = np.searchsorted(codes[places], np.arange(len(ids) + 1)).tolist()
        chosen = []
        for name, at, end in zip(ids.tolist(), cuts, cuts[1:]):
            last = known.get(name)
            if last is not None:
                at = bisect_left(times, last + length, at, end)
            while at < end:
                chosen.append(at)
                last = times[at]
                at = bisect_left(times, last + length, at + 1, end)
            known[name] = last
        known = {name: last for name, last in known.items() if ends(last) > passed}
        if known:
            state.update((list(known), list(known.values())))
            state.setTimeoutTimestamp(ends(max(known.values())))
        elif state.exists:
            state.remove()
        if chosen:
            yield rows.iloc[places[chosen]][columns]

    named, unnamed = shaped.where(F.col(id).isNotNull()), shaped.where(F.col(id).isNull())
    held = "ids array<string>, lasts array<bigint>"
    kept = named.groupBy("_bucket").applyInPandasWithState(accept, shaped.schema, held, "append", "EventTimeTimeout")
    found = kept.unionByName(unnamed).drop("_at", "_order", "_key", "_bucket")
    return found.withColumns({name: F.parse_json(name) for name in variants}) if variants else found


def counted(stream: DataFrame, task: str) -> DataFrame:
    """Count events per task as an observed metric of every batch.

    Read it from ``query.recentProgress[i].observedMetrics[task].events``.
    """
    return stream.observe(task, F.count(F.lit(1)).alias("events"))


def emitted(query: StreamingQuery, task: str) -> int:
    """Events a finished or running query has counted for ``task`` so far."""
    return sum(
        progress.observedMetrics[task]["events"]
        for progress in query.recentProgress
        if task in progress.observedMetrics
    )
