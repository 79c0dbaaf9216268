"""Rows with vectors: which of them count, their directions, bounded samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

# Numbers of a sample that comes to the driver, whatever the length of the vectors.
SAMPLE_NUMBERS = 2_000_000


def is_valid(vector: Column) -> Column:
    """Not null, not zero, and no component null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def numbered(rows: DataFrame, vec_id: str, vector: str, scratch: Scratch) -> DataFrame:
    """Stored ``row, vec_id, vector, cid``: a number for the row, the vector in doubles
    (null unless valid) and a 128-bit digest of it, by which equal vectors are one class."""
    doubles = F.col(vector).cast("array<double>")
    # Adding zero makes one zero of the two.
    plain = F.when(is_valid(doubles), F.transform(doubles, lambda x: x + F.lit(0.0)))
    named = rows.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"), plain.alias("vector"))
    digest = F.concat(F.hex(F.xxhash64("vector")), F.lit("-"), F.hex(F.xxhash64(F.lit("second"), "vector")))
    return scratch.store(named.withColumn("cid", F.when(F.col("vector").isNotNull(), digest)), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def directions(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def sample_directions(classes: DataFrame, count: int, width: int) -> np.ndarray:
    """Directions of at most SAMPLE_NUMBERS / ``width`` of ``count`` classes, those with
    the smallest hashes, in their order."""
    bound = max(64, SAMPLE_NUMBERS // width)
    unit = F.pmod(F.xxhash64("cid", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = classes.where(unit < min(1.0, (bound * 1.1 + 50) / count)).orderBy(unit, "cid").limit(bound)
    return directions(matrix(drawn.select("vector").toArrow()["vector"], width))
