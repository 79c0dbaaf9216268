"""Joins with a table of one row per key that no hot key can fill a task with."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Rows of a table that goes to the driver and is broadcast from there.
HELD_ROWS = 10_000


def held(table: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """The rows of ``table`` computed once, and whether they are at most HELD_ROWS.

    So few come to the driver, any more are stored.
    """
    rows = table.limit(HELD_ROWS + 1).collect()
    if len(rows) <= HELD_ROWS:
        return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema)), True
    return materialize(table, label), False


def left_lookup(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key`` (null is one).

    ``count`` in ``table`` is how many of ``rows`` a key has.  Keys with a
    HELD_ROWS-th of all counted rows are at most HELD_ROWS and come by broadcast; for
    the others rows are shuffled by key, and those of heavy keys are dealt by salt.
    """
    values = [c for c in table.columns if c not in (key, count)]
    named, few = held(table.select(F.col(key).alias("_key"), *values, count), "lookup")
    matched = lambda left: left[key].eqNullSafe(F.col("_key"))
    if few:
        return rows.join(named.drop(count), matched(rows), "left").drop("_key")
    least = math.ceil(named.agg(F.sum(count)).first()[0] / HELD_ROWS)
    heavy = named.where(F.col(count) >= least).drop(count).withColumn("_heavy", F.lit(True))
    out = rows.join(F.broadcast(heavy), matched(rows), "left").drop("_key").withColumnsRenamed({v: f"_heavy_{v}" for v in values})
    salt = F.when(F.col("_heavy"), 1 + F.floor(F.rand(7) * 1_000_000)).otherwise(0)
    out = out.withColumn("_salt", salt.cast("int"))
    rest = named.where(F.col(count) < least).drop(count).withColumn("_zero", F.lit(0))
    out = out.join(rest, matched(out) & (F.col("_salt") == F.col("_zero")), "left")
    chosen = [F.when(F.col("_heavy"), F.col(f"_heavy_{v}")).otherwise(F.col(v)).alias(v) for v in values]
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *chosen)
