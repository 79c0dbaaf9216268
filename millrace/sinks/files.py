"""Landing events in files, with receipts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import to_json_text
from ..functions.template import render
from ..operators.envelope import ERROR

# Date partition columns and payload extensions.
DATE_PARTITIONS = ("year", "month", "day")
EXTENSION_BY_FORM = {"json": "json", "batch": "csv", "record": "avro"}
# Quotes are doubled inside quotes; white space at the ends of a value stays.
CSV_WRITER = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def with_event_date(df: DataFrame, timestamp: str | None = "timestamp") -> DataFrame:
    """Unpadded UTC ``year``/``month``/``day`` from a µs column, or from write time."""
    at = F.current_timestamp() if timestamp is None else F.timestamp_micros(F.col(timestamp))
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.day(at)})


def templated_path(template: str, df: DataFrame) -> Column:
    """Destination of each row, without scheme and host."""
    return F.regexp_replace(render(template, df), r"^[A-Za-z][\w+.-]*://[^/]*", "")


def object_name(form: str, timestamp: str | None = "timestamp") -> Column:
    """``<id or time>.<extension>`` as a column; Spark names the physical files."""
    at = F.unix_micros(F.current_timestamp()) if timestamp is None else F.col(timestamp)
    return F.concat(F.coalesce(F.col("id"), at.cast("string")), F.lit("." + EXTENSION_BY_FORM[form]))


def _flat(df: DataFrame, keep: list[str]) -> DataFrame:
    """Payload fields as top-level columns, for formats without nesting."""
    kind = df.schema["data"].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError("csv needs a record payload")
    return df.select(F.col("data.*"), *keep)


def write_events(
    df: DataFrame,
    path: str,
    format: str = "json",
    *,
    partition_by: list[str] | None = None,
    cluster: bool = True,
    mode: str = "error",
    delimiter: str = ",",
    line_ending: str | None = None,
) -> None:
    """Write payloads: ``json`` lines, ``csv`` with header, ``parquet`` or ``avro``.

    One distributed write.  With partitions, rows are rebalanced by partition value
    first: adaptive execution splits a hot value over several tasks and merges rare
    ones, so files come out near the advisory size and a value's rows do not scatter
    into one file per task.  ``cluster=False`` skips that shuffle for input that is
    already ordered by partition value.
    """
    partitions = list(partition_by or [])
    if partitions and cluster:
        df = df.hint("rebalance", *[F.col(p) for p in partitions])
    if format == "json":
        out = df.select("data", *partitions)
        kind = df.schema["data"].dataType
        # A string payload is a JSON string: quoted, with its line feeds escaped.
        text = to_json_text(F.col("data"), kind)
        writer = out.select(text.alias("value"), *partitions).write.mode(mode)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.option("lineSep", line_ending or "\n").format("text").save(path)
        return
    out = _flat(df, partitions)
    writer = out.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.options(**CSV_WRITER).option("header", True).option("sep", delimiter)
        if line_ending is not None:
            writer = writer.option("lineSep", line_ending)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def write_split(df: DataFrame, path: str, format: str = "parquet", *, mode: str = "error") -> None:
    """Good and bad rows in one pass, as ``outcome=good`` / ``outcome=error``."""
    outcome = F.when(F.col(ERROR).isNull(), F.lit("good")).otherwise(F.lit("error"))
    df.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").format(format).save(path)


def run_folder(path: str, run: str) -> str:
    """Where one run writes below a destination: a partition of its own."""
    return f"{path.rstrip('/')}/run={run}"


def write_run(
    df: DataFrame, path: str, format: str, write: Callable[[DataFrame, str], None], *, run: str | None = None, payload: T.StructType | None = None
) -> DataFrame:
    """Write ``df`` by ``write(df, folder)`` into a run's own folder, and its receipts.

    Only that folder is listed and read, whatever the destination held before.  The same
    ``run`` again (a repeated batch) replaces what it wrote; without one a run is new.
    A write of no rows has no receipts.
    """
    folder, counted = run_folder(path, run or uuid.uuid4().hex), Observation()
    write(df.observe(counted, F.count(F.lit(1)).alias("rows")), folder)
    receipts = write_receipts(df.sparkSession, folder, format, payload=payload)
    return receipts if counted.get["rows"] else receipts.limit(0)


def write_receipts(spark: SparkSession, path: str, format: str, *, payload: T.StructType | None = None) -> DataFrame:
    """One receipt per file below ``path``: status, path, rows, bytes, e_tag.

    ``payload`` is the schema of the payload; with it a write of no rows, which leaves no
    file to infer one from, has no receipts instead of failing.  The tag stands for
    content identity: name, size and modification time.
    """
    reader = spark.read.format("text" if format == "json" else format)
    if payload is not None and format != "json":
        reader = reader.schema(payload)
    if format == "csv":
        reader = reader.option("header", True).options(quote='"', escape='"', multiLine="true")
    meta = reader.load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("_changed"),
    )
    files = meta.groupBy("path", "bytes", "_changed").agg(F.count(F.lit(1)).alias("rows"))
    return files.select(
        F.lit("success").alias("status"),
        "path",
        "rows",
        "bytes",
        F.md5(F.concat_ws("|", "path", "bytes", F.unix_micros("_changed")).cast("binary")).alias("e_tag"),
    )
