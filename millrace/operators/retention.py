"""Limits on a message table: age, count, bytes, message size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lookup import held, left_lookup

# Sequences are unique, so a bucket of width 2^15 holds at most that many messages.
# Narrowing in steps of 2^15 keeps each step's totals to tens of thousands of rows
# for tables of up to 2^45 messages.
_SHIFTS = (30, 15, 0)
# Bits of a sequence that one step of the per-key narrowing settles.
_BITS = 12


@dataclass(frozen=True)
class Limits:
    max_age_secs: int | None = None
    max_messages_per_subject: int | None = None
    max_messages: int | None = None
    max_bytes: int | None = None
    max_message_size: int | None = None
    discard: str = "old"

    def __post_init__(self) -> None:
        if self.discard not in ("old", "new"):
            raise ValueError("discard is 'old' or 'new'")


def retain_age(messages: DataFrame, max_age_secs: int, *, now: Column, timestamp: str = "timestamp") -> DataFrame:
    """Messages at most ``max_age_secs`` old at ``now`` (µs). A scan-level filter."""
    return messages.where(F.col(timestamp) >= now - F.lit(max_age_secs * 1_000_000))


def retain_size(messages: DataFrame, max_message_size: int, size: str = "bytes") -> DataFrame:
    """Messages no larger than the limit."""
    return messages.where(F.col(size) <= max_message_size)


def _cut(messages: DataFrame, sequence: str, weight: Column, limit: int, newest: bool) -> int | None:
    """The sequence at which the running total first exceeds ``limit``; None if never.

    Totals per coarse sequence bucket (map-side combined) find the bucket in which
    the limit is crossed; only that bucket is read again, twice, at finer width.
    Each step returns one row, whose literal bounds prune the next step's scan.
    """
    within, used = messages, 0
    for shift in _SHIFTS:
        totals = within.groupBy(F.shiftright(sequence, shift).alias("_bucket")).agg(
            F.sum(weight).alias("_w")
        )
        direction = F.col("_bucket").desc() if newest else F.col("_bucket").asc()
        running = Window.orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
        crossed = (
            totals.withColumn("_total", F.sum("_w").over(running) + used)
            .where(F.col("_total") > limit)
            .orderBy(direction)
            .select("_bucket", (F.col("_total") - F.col("_w")).alias("_used"))
            .first()
        )
        if crossed is None:
            return None
        used = crossed["_used"]
        low = crossed["_bucket"] << shift
        within = messages.where(F.col(sequence).between(low, low + (1 << shift) - 1))
    return low


def _cuts_by_key(messages: DataFrame, key: str, sequence: str, limit: int, newest: bool) -> DataFrame | None:
    """``_cut`` for message counts, for every key at once: (key, ``_cut``, ``_rows``).

    Keys that never exceed the limit have no row; None if no key does.  Each step counts
    the messages of every key by ranges of sequences, map-side combined, and keeps for
    each key the range in which its limit is crossed; the next step counts within those.
    A key has at most 2^12 ranges in a step, whatever its share of the messages.
    """
    first, last = messages.agg(F.min(sequence), F.max(sequence)).first()
    if first is None:
        return None
    place = F.col(sequence) - F.lit(first)
    shift = max(0, (last - first).bit_length() - _BITS)
    within = messages.select(key, place.alias("_s"), F.lit(0).cast("bigint").alias("_used"))
    direction = F.col("_range").desc() if newest else F.col("_range").asc()
    running = Window.partitionBy(key).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    total, rows = F.col("_total"), F.sum("_w").over(whole)
    while True:
        totals = within.groupBy(key, F.shiftright("_s", shift).alias("_range")).agg(F.count(F.lit(1)).alias("_w"), F.max("_used").alias("_used"))
        crossed = (
            totals.withColumns({"_total": F.sum("_w").over(running) + F.col("_used"), "_rows": rows})
            .where((total > limit) & (total - F.col("_w") <= limit))
            .select(key, "_range", (total - F.col("_w")).alias("_used"), "_rows")
        )
        found, few = held(crossed, "retain-ranges")
        if few and found.isEmpty():
            return None
        if shift == 0:
            return found.select(key, (F.col("_range") + F.lit(first)).alias("_cut"), "_rows")
        narrow = found.select(F.col(key).alias("_key"), F.col("_range").alias("_parent"), "_used")
        # Of one key only a 2^12-th of its sequences is left; more keys than are held meet
        # their messages by key and range.
        match = F.col(key).eqNullSafe(F.col("_key")) & (F.shiftright(place, shift) == F.col("_parent"))
        within = messages.join(F.broadcast(narrow) if few else narrow, match).select(key, place.alias("_s"), "_used")
        shift = max(0, shift - _BITS)


def _retain_running(
    messages: DataFrame, sequence: str, weight: Column, limit: int, discard: str
) -> DataFrame:
    # The table itself is only filtered, never moved, and the literal comparison
    # reaches the file scan.
    newest = discard == "old"
    cut = _cut(messages, sequence, weight, limit, newest)
    if cut is None:
        return messages
    return messages.where(F.col(sequence) > cut if newest else F.col(sequence) < cut)


def retain_total(messages: DataFrame, max_messages: int, *, sequence: str = "sequence", discard: str = "old") -> DataFrame:
    """Newest (or, discarding new, oldest) ``max_messages`` by sequence."""
    return _retain_running(messages, sequence, F.lit(1).cast("bigint"), max_messages, discard)


def retain_bytes(
    messages: DataFrame, max_bytes: int, *, sequence: str = "sequence", size: str = "bytes", discard: str = "old"
) -> DataFrame:
    """Longest run of newest (or oldest) messages whose sizes add up to ≤ ``max_bytes``."""
    return _retain_running(messages, sequence, F.col(size).cast("bigint"), max_bytes, discard)


def retain_per_subject(
    messages: DataFrame,
    max_per_subject: int,
    *,
    sequence: str = "sequence",
    subject: str = "subject",
    discard: str = "old",
) -> DataFrame:
    """Newest (or oldest) ``max_per_subject`` messages of every subject; NULL is one.

    No subject's messages are sorted or gathered in one task, whatever the limit: each
    subject's cut comes from range totals, and the table is filtered on the cuts of the
    subjects above the limit.  Those few are broadcast; of more than a bounded number,
    the ones with many messages are, and only the others' messages are shuffled.
    """
    newest = discard == "old"
    cuts = _cuts_by_key(messages, subject, sequence, max_per_subject, newest)
    if cuts is None:
        return messages
    joined = left_lookup(messages, cuts, subject, "_rows")
    inside = F.col(sequence) > F.col("_cut") if newest else F.col(sequence) < F.col("_cut")
    return joined.where(F.col("_cut").isNull() | inside).select(*[F.col(f"`{c}`") for c in messages.columns])


def retain(messages: DataFrame, limits: Limits, *, now: Column) -> DataFrame:
    """All declared limits: size, age, per subject, total, bytes."""
    kept = messages
    if limits.max_message_size is not None:
        kept = retain_size(kept, limits.max_message_size)
    if limits.max_age_secs is not None:
        kept = retain_age(kept, limits.max_age_secs, now=now)
    if limits.max_messages_per_subject is not None:
        kept = retain_per_subject(kept, limits.max_messages_per_subject, discard=limits.discard)
    if limits.max_messages is not None:
        kept = retain_total(kept, limits.max_messages, discard=limits.discard)
    if limits.max_bytes is not None:
        kept = retain_bytes(kept, limits.max_bytes, discard=limits.discard)
    return kept
