"""Duplicate detection inside a time window, measured from the last accepted row.

The rule is sequential: a row is accepted if the id's last accepted row lies a window or
more before it.  Rows of one id are reduced to their distinct times and put in ranges of
(id, time), so a range cuts at most one id at its start.  Every id that starts inside a
range is walked to its end there.  For the one id that may go on from earlier ranges, the
range gives its *transfer*: for each time at which the walk may enter, the time at which
it leaves.  Those transfers, at most one window of times for each range, are composed
over the ranges, and the ranges are then walked from where they are entered.  Nothing
depends on how many rows an id has.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.durations import duration_micros
from ..session import materialize


def _walk(times: list[int], start: int, end: int, window: int) -> Iterator[int]:
    """Places of the accepted times of ``times[start:end]``, the first one included."""
    at = start
    while at < end:
        yield at
        at = bisect_left(times, times[at] + window, at + 1, end)


def exits(times: np.ndarray, window: int) -> np.ndarray:
    """The last place of the walk from each place, all at once by following the followers."""
    follower = np.searchsorted(times, times + window)
    last = follower == len(times)
    out = np.where(last, np.arange(len(times)), follower)
    while True:
        further = out[out]
        if (further == out).all():
            return out
        out = further


def _segments(ids: pa.Array) -> np.ndarray:
    """Where each id's rows begin, and the end."""
    if not len(ids):
        return np.zeros(1, np.int64)
    changes = np.array(pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_pylist(), bool)
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(ids)]])


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [batch for batch in batches if batch.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _ranges(window: int):
    """Sorted ``_id, _ts, _tie`` of one range, with ``_part``, ``_accepted`` (null for the
    first id, which may go on from an earlier range) and ``_exit`` of its first times.
    Before the first range there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        ids, times = rows.column("_id").combine_chunks(), rows.column("_ts").to_numpy()
        part, cuts, listed = TaskContext.get().partitionId(), _segments(ids), times.tolist()
        waiting = int(cuts[1]) if part else 0
        accepted = np.zeros(len(times), bool)
        accepted[cuts[:-1]] = True
        for start, end in zip(cuts.tolist(), cuts[1:].tolist()):
            # Ids whose times lie within one window are done.
            if start >= waiting and listed[end - 1] >= listed[start] + window:
                accepted[list(_walk(listed, start, end, window))] = True
        # The walk enters at the first time a window after some time before this range.
        first = times[:waiting]
        enters = min(waiting, int(np.searchsorted(first, first[0] + window)) + 1) if waiting else 0
        leaves = np.zeros(len(times), np.int64)
        leaves[:enters] = first[exits(first, window)[:enters]]
        place = np.arange(len(times))
        columns = {
            "_id": ids,
            "_ts": pa.array(times),
            "_tie": rows.column("_tie").combine_chunks(),
            "_part": pa.array(np.full(len(times), part, np.int32)),
            "_accepted": pa.array(accepted, mask=place < waiting),
            "_exit": pa.array(leaves, mask=place >= enters),
        }
        yield from pa.table(columns).to_batches(max_chunksize=100_000)

    return run


def _entered(window: int):
    """Sorted ``_id, _ts, _tie, _entry`` of ranges: the accepted ones of those entered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        parts, times = rows.column("_part").to_numpy(), rows.column("_ts").to_numpy().tolist()
        entries = rows.column("_entry").to_pylist()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        chosen = [
            place
            for start, end in zip(cuts, cuts[1:])
            for place in _walk(times, bisect_left(times, entries[start], start, end), end, window)
        ]
        yield from rows.select(["_id", "_ts", "_tie"]).take(pa.array(chosen, pa.int64())).to_batches()

    return run


def _followers(leaving: DataFrame, waiting: DataFrame, window: int) -> DataFrame:
    """``_id, _ts, _next, _next_part``: for each time of ``leaving`` (``_id, _ts, _exit``)
    the first of the ``waiting`` times a window or more after its exit.

    Which range that is follows from the last times of the ranges, one row each; within a
    range it is the first time that a walk may enter at.
    """
    ends = waiting.groupBy("_id", "_part").agg(F.max("_ts").alias("_end"), F.min("_ts").alias("_begin"))
    earlier = Window.partitionBy("_id").orderBy("_part")
    ends = ends.withColumn("_before", F.coalesce(F.lag("_end").over(earlier), F.lit(-(2**63))))
    probes = leaving.select("_id", "_ts", (F.col("_exit") + window).alias("_at"))
    # At most one waiting id a range, so a row a range.
    placed = probes.join(F.broadcast(ends), "_id").where((F.col("_at") <= F.col("_end")) & (F.col("_at") > F.col("_before")))
    inside = placed.select("_id", "_part", F.greatest("_at", "_begin").alias("_at"), F.col("_ts").alias("_from"), F.lit(1).alias("_probe"))
    nodes = waiting.where(F.col("_exit").isNotNull()).select("_id", "_part", F.col("_ts").alias("_at"), F.lit(None).cast("bigint").alias("_from"), F.lit(2).alias("_probe"))
    # From the last row back: a frame up to the end would be computed anew for each row.
    ahead = Window.partitionBy("_id", "_part").orderBy(F.desc("_at"), F.desc("_probe")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = inside.unionByName(nodes).withColumn("_next", F.min(F.when(F.col("_probe") == 2, F.col("_at"))).over(ahead))
    return found.where("_probe = 1").select("_id", F.col("_from").alias("_ts"), "_next", F.col("_part").alias("_next_part")).where(F.col("_next").isNotNull())


def _entries(walked: DataFrame, waiting: DataFrame, window: int) -> DataFrame:
    """``_id, _part, _entry``: where the walk of each id enters the ranges it comes to.

    From the transfers of the ranges.  A link leads from an entry to the entry of a later
    range; links are composed pairwise, so that the rounds are the logarithm of the number
    of ranges that one id lies in.
    """
    known = waiting.select("_id").distinct()
    last = walked.where("_accepted").join(F.broadcast(known), "_id", "left_semi").groupBy("_id").agg(F.max("_ts").alias("_ts"))
    first = waiting.groupBy("_id").agg(F.min_by("_part", "_ts").alias("_part"), F.min("_ts").alias("_entry"))
    begun = materialize(last.select("_id", "_ts", F.col("_ts").alias("_exit")), "dedup-begun")
    at_start = first.join(begun, "_id", "left_anti").select("_id", "_part", "_entry")
    leaving = waiting.where(F.col("_exit").isNotNull()).select("_id", "_ts", "_exit")
    found = at_start.unionByName(_followers(begun, waiting, window).select("_id", F.col("_next_part").alias("_part"), F.col("_next").alias("_entry")))
    found = materialize(found, "dedup-entries")
    links = materialize(_followers(leaving, waiting, window), "dedup-links")
    count = found.count()
    while True:
        reached = found.join(links, (found["_id"] == links["_id"]) & (found["_entry"] == links["_ts"])).select(
            found["_id"], links["_next_part"].alias("_part"), links["_next"].alias("_entry")
        )
        found = materialize(found.unionByName(reached), "dedup-entries")
        total = found.count()
        if total == count:
            return found
        count = total
        onward = links.select("_id", F.col("_ts").alias("_next"), F.col("_next").alias("_then"), F.col("_next_part").alias("_then_part"))
        links = materialize(
            links.join(onward, ["_id", "_next"]).select("_id", "_ts", F.col("_then").alias("_next"), F.col("_then_part").alias("_next_part")), "dedup-links"
        )


def accepted(df: DataFrame, id: str, timestamp: str, tie: str, window: int | str, *, ranges: int | None = None) -> DataFrame:
    """(``_id``, ``_ts``, ``_tie``) of the rows a windowed duplicate check accepts.

    ``ranges`` sets the number of (id, time) ranges; without it adaptive execution merges
    small ones.
    """
    length = duration_micros(window) if isinstance(window, str) else window
    if length <= 0:
        raise ValueError("a duplicate window is longer than nothing")
    rows = df.select(
        F.col(id).alias("_id"), F.col(timestamp).cast("bigint").alias("_ts"), F.col(tie).cast("bigint").alias("_tie")
    ).where(F.col("_id").isNotNull() & F.col("_ts").isNotNull())
    nodes = materialize(rows.groupBy("_id", "_ts").agg(F.min("_tie").alias("_tie")), "dedup-times")
    dealt = nodes.repartitionByRange(ranges, "_id", "_ts") if ranges else nodes.repartitionByRange("_id", "_ts")
    kind = nodes.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, _ts long, _tie long"
    walked = materialize(
        dealt.sortWithinPartitions("_id", "_ts").mapInArrow(_ranges(length), f"{shape}, _part int, _accepted boolean, _exit long"), "dedup-walked"
    )
    done = walked.where("_accepted").select("_id", "_ts", "_tie")
    waiting = walked.where(F.col("_accepted").isNull())
    if waiting.isEmpty():
        return done
    entries = _entries(walked, waiting, length)
    entered = waiting.select("_id", "_ts", "_tie", "_part").join(F.broadcast(entries), ["_id", "_part"])
    dealt = entered.repartition("_part").sortWithinPartitions("_part", "_ts").select("_id", "_ts", "_tie", "_part", "_entry")
    return done.unionByName(dealt.mapInArrow(_entered(length), shape))


def mark_duplicates(df: DataFrame, id: str, timestamp: str, tie: str, window: int | str, *, ranges: int | None = None) -> DataFrame:
    """Add ``duplicate``: a repeat of an id within ``window`` of its last accepted row.

    ``tie`` orders rows of one id at the same time and makes them distinct.  Rows
    without an id or a time are never duplicates.
    """
    kept = accepted(df, id, timestamp, tie, window, ranges=ranges).select(
        F.col("_id").alias("_kept_id"), F.col("_ts").alias("_kept_ts"), F.col("_tie").alias("_kept_tie")
    )
    match = [
        df[id] == F.col("_kept_id"),
        df[timestamp] == F.col("_kept_ts"),
        df[tie].cast("bigint") == F.col("_kept_tie"),
    ]
    return (
        df.join(kept, match, "left")
        .withColumn("duplicate", df[id].isNotNull() & df[timestamp].isNotNull() & F.col("_kept_id").isNull())
        .drop("_kept_id", "_kept_ts", "_kept_tie")
    )


def dedup(df: DataFrame, id: str, timestamp: str, tie: str, window: int | str, *, ranges: int | None = None) -> DataFrame:
    """Only the accepted rows."""
    marked = mark_duplicates(df, id, timestamp, tie, window, ranges=ranges)
    return marked.where(~F.col("duplicate")).drop("duplicate")
