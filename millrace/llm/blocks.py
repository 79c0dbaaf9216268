"""Work on the groups of a key, none of which has to fit one task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_block_pairs(rows: DataFrame, sizes: DataFrame, key: str, by: str, limit: int) -> DataFrame:
    """Deal the rows of each key to tasks so that any two of them meet.

    ``sizes`` has ``key`` and ``count``; keys that are not in it are left out.  A key
    with up to ``limit`` rows is one task (0, 0).  A larger one is cut by the hash of
    ``by`` into blocks of about that size, and every pair of blocks is a task
    (``left`` <= ``right``); ``block`` tells on which side a row stands.
    """
    blocks = F.ceil(F.col("count") / limit).cast("int")
    dealt = rows.join(sizes.select(key, blocks.alias("_blocks")), key).withColumn(
        "block", F.pmod(F.xxhash64(by, F.lit("block")), F.col("_blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        dealt.withColumn("_other", other)
        .withColumn("left", F.least("block", "_other"))
        .withColumn("right", F.greatest("block", "_other"))
        .drop("_blocks", "_other")
    )


def map_groups(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], Iterable[pa.Table]], schema: str) -> DataFrame:
    """Apply ``work`` to the rows of each combination of ``keys``, as Arrow tables.

    The rows are dealt by the keys and sorted, and each task walks its groups one after
    the other, so that very many small groups cost little and one group is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None

        def finish():
            for table in work(pa.Table.from_batches(held)):
                yield from table.to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            changes = np.zeros(batch.num_rows - 1, bool)
            for column in columns:
                changes |= column.slice(1).to_numpy(zero_copy_only=False) != column.slice(0, batch.num_rows - 1).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                key = tuple(column[start].as_py() for column in columns)
                if held and key != held_key:
                    yield from finish()
                    held = []
                held_key = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from finish()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def map_whole_groups(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], Iterable[pa.Table]], schema: str) -> DataFrame:
    """``map_groups`` with all groups that end in an Arrow batch at once: ``work`` also gets,
    for each row, where its group ends.  One batch and one group are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish():
            table = pa.Table.from_batches(held)
            last = np.append(np.flatnonzero(_changes(table, keys)) + 1, table.num_rows)
            for found in work(table, np.repeat(last, np.diff(last, prepend=0))):
                yield from found.to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            if held:
                seam = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
                if _changes(seam, keys)[0]:
                    yield from finish()
                    held = []
            changes = np.flatnonzero(_changes(batch, keys))
            if len(changes):
                held.append(batch.slice(0, changes[-1] + 1))
                yield from finish()
                held = [batch.slice(changes[-1] + 1)]
            else:
                held.append(batch)
        if held:
            yield from finish()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def map_beside_groups(
    rows: DataFrame, keys: list[str], beside: str, most: int, prepare: Callable[[pa.Table], Any], work: Callable[[Any, pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Meet the rows of each combination of ``keys`` for which ``beside`` is true with the others.

    ``prepare`` gets the others of a group as one table; ``work`` gets what it returned and,
    ``most`` at a time, the rows beside them, of which a group may have any number.  A group
    without others is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key, ready = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = [0, *(np.flatnonzero(_changes(batch, [*keys, beside])) + 1).tolist(), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                key = tuple(batch.column(k)[start].as_py() for k in keys)
                if key != held_key:
                    held_key, held, ready = key, [], None
                if not batch.column(beside)[start].as_py():
                    held.append(batch.slice(start, end - start))
                    continue
                if ready is None and held:
                    ready, held = prepare(pa.Table.from_batches(held)), []
                if ready is not None:
                    for n in range(start, end, most):
                        yield from work(ready, batch.slice(n, min(most, end - n)))

    return rows.repartition(*keys).sortWithinPartitions(*keys, beside).mapInArrow(run, schema)


def _changes(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether each row but the first begins another group."""
    out = np.zeros(rows.num_rows - 1, bool)
    for name in keys:
        values = rows.column(name).to_numpy() if isinstance(rows, pa.Table) else rows.column(name).to_numpy(zero_copy_only=False)
        out |= values[1:] != values[:-1]
    return out


class Forest:
    """Which of a few numbered things hang together."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
