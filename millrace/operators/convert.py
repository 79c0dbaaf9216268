"""Payload conversion between JSON, declared records and row batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload as P
from ..functions.evolution import with_evolved
from ..functions.records import parse_schema, with_record
from . import errors
from .lookup import held, left_lookup
from .sequence import assign_sequence

# Fixed value: rows of a batch where nothing else is set.
DEFAULT_BATCH_ROWS = 10_000


def payload_form(df: DataFrame) -> str:
    """``json`` for VARIANT, ``record`` for a typed struct, ``text`` otherwise."""
    kind = df.schema["data"].dataType
    if isinstance(kind, T.VariantType):
        return "json"
    if isinstance(kind, T.StructType):
        return "record"
    return "text"


def check_conversion(source: str, target: str) -> None:
    """Which conversions exist.  Row batches must become JSON before records."""
    if target not in ("json", "record"):
        raise ValueError(f"unknown conversion target {target!r}")
    if source == "batch" and target == "record":
        raise ValueError(errors.UNSUPPORTED_CONVERSION + ": convert the batch to json first")


def to_record(
    df: DataFrame, schema: str | dict | None, *, normalize: bool = True, form: str | None = None, writer: str | dict | None = None
) -> DataFrame:
    """JSON payload → declared record; rows that do not conform are marked.

    ``form="record"`` says that the payload is a declared record already: it passes
    through.  Typed columns alone are not: they are conformed like the JSON they stand
    for.  Top-level hyphens are normalised first.  No schema, or one that cannot be
    read, fails when the plan is built.
    """
    if schema is None:
        raise ValueError("Missing required attribute: schema")
    declared = parse_schema(schema)
    if writer is not None:
        written = parse_schema(writer)
        read = df if form == "record" else to_record(df, writer, normalize=normalize)
        evolved = with_evolved(read, "data", written, declared)
        misfit = F.when(F.col("data").isNotNull() & ~F.col("_ok"), F.lit(errors.SCHEMA_MISMATCH))
        return errors.mark(evolved, misfit).withColumn("data", F.when(F.col("_ok"), F.col("_record"))).drop("_record", "_ok")
    if form == "record":
        return df
    if payload_form(df) == "record":
        staged = df.withColumn("_json", P.to_variant(F.col("data"), df.schema["data"].dataType))
    elif payload_form(df) == "text":
        staged = P.with_json(df, "_json", F.col("data"))
    else:
        staged = df.withColumn("_json", F.col("data"))
    read = with_record(staged, "_json", declared, hyphens=normalize)
    marked = errors.mark(
        read,
        F.when(F.col("_json").isNull(), F.lit(errors.INVALID_JSON)).when(
            ~F.col("_ok"), F.lit(errors.SCHEMA_MISMATCH)
        ),
    )
    return marked.withColumn("data", F.when(F.col("_ok"), F.col("_record"))).drop("_json", "_record", "_ok")


def to_json_value(df: DataFrame) -> DataFrame:
    """Record → JSON (VARIANT); JSON stays as it is."""
    kind = df.schema["data"].dataType
    if isinstance(kind, T.VariantType):
        return df
    return df.withColumn("data", P.to_variant(F.col("data"), kind))


def with_batch_id(df: DataFrame, rows_per_batch: int) -> DataFrame:
    """Chunk rows as they are read, ``rows_per_batch`` per chunk within a split.

    Needs no shuffle and no global row number; a batch never spans two splits.
    """
    position = F.monotonically_increasing_id()
    split = F.shiftright(position, 33)
    chunk = F.floor(position.bitwiseAND(F.lit((1 << 33) - 1)) / rows_per_batch)
    return df.withColumn("batch_id", F.shiftleft(split, 33) + chunk)


def batch_to_json(
    df: DataFrame, batch: Column | str, row: Column, *, order_by: str, chunk_rows: int = DEFAULT_BATCH_ROWS
) -> DataFrame:
    """JSON arrays of row objects, rows in ``order_by`` order: (batch_id, chunk, n_rows, data).

    A batch of any size comes out in chunks of ``chunk_rows`` rows, the last one
    shorter, so no value and no task holds a whole batch.  Batches of one chunk are
    gathered by one shuffle.  Rows of longer ones are numbered over (batch, order) by
    range partitions first; a chunk is a run of those numbers.
    """
    key = F.col(batch) if isinstance(batch, str) else batch
    keyed = df.select(key.alias("batch_id"), F.col(order_by).alias("_order"), row.alias("_row"))
    counts = keyed.groupBy(F.col("batch_id").alias("_batch")).agg(F.count(F.lit(1)).alias("_rows"))
    long, few = held(counts.where(F.col("_rows") > chunk_rows), "long-batches")
    is_long = F.col("batch_id").eqNullSafe(F.col("_batch"))
    some = not (few and long.isEmpty())
    short = (keyed.join(long, is_long, "left_anti") if some else keyed).withColumn("_number", F.monotonically_increasing_id())
    gathered = short.groupBy("batch_id").agg(
        F.lit(0).cast("long").alias("chunk"),
        F.count(F.lit(1)).alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("_order", "_number", "_row"))).alias("_rows"),
    )
    arrays = gathered.select("batch_id", "chunk", "n_rows", F.transform("_rows", lambda e: e["_row"]).alias("_rows"))
    if some:
        placed = assign_sequence(keyed.join(long, is_long, "left_semi"), ["batch_id", "_order"], column="_number")
        starts = placed.groupBy("batch_id").agg(F.min("_number").alias("_start"), F.count(F.lit(1)).alias("_count"))
        chunked = left_lookup(placed, starts, "batch_id", "_count")
        chunked = chunked.withColumn("chunk", F.floor((F.col("_number") - F.col("_start")) / chunk_rows))
        gathered = chunked.groupBy("batch_id", "chunk").agg(
            F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_list(F.struct("_number", "_row"))).alias("_rows")
        )
        arrays = arrays.unionByName(gathered.select("batch_id", "chunk", "n_rows", F.transform("_rows", lambda e: e["_row"]).alias("_rows")))
    return arrays.select("batch_id", "chunk", "n_rows", F.to_json("_rows", {"ignoreNullFields": "false"}).alias("data"))
