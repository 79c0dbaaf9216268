"""Bounded samples of labelled rows that are the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows kept beyond the bound before the exact cut, as a share of it.
SPARE = 0.25


def bounded_sample(rows: DataFrame, bound: int, key: str, per: str) -> DataFrame:
    """At most ``bound`` rows for each value of ``per``, those with the smallest hash of ``key``.

    Counts come first, so that only about ``bound`` rows per value pass the hash filter
    and are shuffled for the exact cut, however many there are.  ``per`` is a label with
    few values: its counts go to the driver.
    """
    counts = rows.groupBy(per).count().collect()
    unit = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    passing = F.lit(False)
    for value, count in counts:
        share = min(1.0, (bound * (1 + SPARE) + 20) / count)
        passing = passing | (F.col(per).eqNullSafe(F.lit(value)) & (F.col("_unit") < share))
    first = Window.partitionBy(per).orderBy("_unit", key)
    return (
        rows.withColumn("_unit", unit)
        .where(passing)
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= bound)
        .drop("_unit", "_place")
    )
