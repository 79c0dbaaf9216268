"""Gap-free sequence numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row position below


def assign_sequence(
    df: DataFrame,
    order_by: list[str],
    *,
    start: int = 1,
    column: str = "sequence",
    skip: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, …`` in ``order_by`` order.

    Rows whose ``skip`` flag is true stay in the result without a number.

    Rows that are equal in the ordering key are told apart by a row number, so one hot
    timestamp with no ids does not fill one task.  The number is not the same when
    computed again, so the rows are stored with it first; the sampling for the ranges
    then reads the stored key columns instead of the plan.  Range-partition on key and
    number, sort inside the partitions, and store the rows with their position.  Row
    counts per partition — one small row each — give every partition its offset.
    """
    df = materialize(df.withColumn("_tie_break", F.monotonically_increasing_id()), "sequence-input")
    order_by = [*order_by, "_tie_break"]
    # Skipped rows go last in their partition, so the others keep dense positions.
    inner_order = order_by if skip is None else [skip, *order_by]
    # Without a count, adaptive execution merges small neighbouring ranges.
    ranges = [*order_by] if partitions is None else [partitions, *order_by]
    placed = materialize(
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*inner_order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "sequence",
    )
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per range partition.
    numbered = F.lit(True) if skip is None else ~F.col(skip)
    counts = placed.groupBy(part.alias("_part")).agg(F.count_if(numbered).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(column, F.when(numbered, F.lit(start) + F.col("_before") + row))
        .drop("_part", "_place", "_before", "_tie_break")
    )
