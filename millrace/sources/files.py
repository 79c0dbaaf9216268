"""File sources: JSON documents, delimited text and mixed folders."""

from __future__ import annotations

import csv
import io
import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import with_json
from ..functions.template import render
from ..operators import errors
from ..operators.envelope import ERROR
from ..session import listing, materialize
from . import delimited

log = logging.getLogger(__name__)

# File extensions with a reader, and reader defaults.
EXTENSIONS = ("json", "csv", "avro")
INFER_RECORDS = 100

# Paths that are read by name; beyond, a folder is read whole and joined.
NAMED_PATHS = 10_000

CORRUPT = "_corrupt_record"


def _paths(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_json_docs(spark: SparkSession, paths: str | list[str], *, recursive: bool = True) -> DataFrame:
    """One whole JSON document per file: (path, data VARIANT).

    A file that does not parse stays as a row marked ``InvalidJson``.
    """
    with listing(spark):
        texts = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").text(_paths(paths), wholetext=True)
    files = texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("_text"))
    parsed = with_json(files, "data", F.col("_text"))
    return errors.mark(
        parsed, F.when(F.col("data").isNull(), F.lit(errors.INVALID_JSON))
    ).drop("_text")


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Landed JSON Lines, one event per line: typed by ``schema``, else VARIANT.

    Partition columns of the layout are kept beside ``data``.  A line that does not
    parse stays as a row marked ``InvalidJson``.
    """
    lines = spark.read.text(_paths(paths))
    if schema is None:
        out = with_json(lines, "data", F.col("value")).drop("value")
    else:
        out = lines.withColumn("data", F.from_json("value", schema)).drop("value")
    return errors.mark(out, F.when(F.col("data").isNull(), F.lit(errors.INVALID_JSON)))


# Delimited text as RFC 4180 has it, for readers and the writer.  Quotes
# are doubled inside quotes, and a quoted value may hold delimiters and line ends.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _csv_reader(spark: SparkSession, has_header: bool, delimiter: str, multi_line: bool, line_ending: str | None = None):
    reader = spark.read.options(**CSV_OPTIONS).option("header", has_header).option("sep", delimiter[:1])
    reader = reader.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    # With line ends inside values, the reader finds the line end by itself.
    return reader.option("lineSep", line_ending) if line_ending is not None and not multi_line else reader


def infer_csv_schema(
    spark: SparkSession, paths: str | list[str], *, has_header: bool = True, delimiter: str = ",", options: dict[str, str] | None = None
) -> T.StructType:
    """Column types from the first 100 records; integers are 64-bit."""
    read = _csv_reader(spark, has_header, delimiter, True).options(**(options or {})).csv(_paths(paths))
    return _typed(spark, read.columns, read.limit(INFER_RECORDS).collect())


def _typed(spark: SparkSession, names: list[str], records: list) -> T.StructType:
    """Types of a few records of strings."""
    lines = io.StringIO()
    writer = csv.writer(lines, lineterminator="\n")
    texts = []
    for record in [names, *records]:
        lines.seek(0)
        lines.truncate()
        writer.writerow(["" if v is None else v for v in record])
        texts.append(lines.getvalue())
    sample = spark.read.options(**CSV_OPTIONS).csv(
        spark.sparkContext.parallelize(texts, 1), header=True, inferSchema=True
    )
    return T.StructType(
        [
            T.StructField(name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType, True)
            for name, f in zip(names, sample.schema.fields)
        ]
    )


def read_csv_typed(
    spark: SparkSession,
    paths: str | list[str],
    *,
    has_header: bool = True,
    delimiter: str = ",",
    schema: T.StructType | None = None,
    line_ending: str | None = None,
) -> DataFrame:
    """Delimited text as typed columns, every file read in splits.

    Only the first byte of ``delimiter`` counts.  Types come from ``schema`` or the
    first 100 records; a later row that does not fit is marked, not dropped.  All files
    must have one header: another one is an error here, see ``read_objects``.

    One pass finds the files in which a record goes over several lines.  The others are
    read line by line as they are; of these the records are put together first.
    """
    columns = schema or infer_csv_schema(spark, paths, has_header=has_header, delimiter=delimiter)
    names = columns.fieldNames()
    wanted = _with_corrupt(columns)
    reader = (
        _csv_reader(spark, has_header, delimiter, False, line_ending)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", not has_header)
    )
    raw = reader.schema(wanted).csv(_paths(paths))
    lines = delimited.text_lines(spark, _paths(paths), line_ending=line_ending)
    if not delimited.over_lines(lines, delimiter[:1]):
        return errors.mark(raw, _csv_error(names[0])).drop(CORRUPT)
    states = delimited.split_states(lines, delimiter[:1])
    spread = states.where(F.col("opens") | F.col("quoted_returns")).select("file").distinct()
    spread = delimited.small(materialize(spread, "csv-spread"))
    whole = raw.withColumn("_file", F.col("_metadata.file_path")).join(spread.withColumnRenamed("file", "_file"), "_file", "left_anti").drop("_file")
    own = states.join(spread, "file", "left_semi")
    found = delimited.records(lines.join(spread, "file", "left_semi"), own, delimiter[:1], line_ending=line_ending)
    folders = [c for c in lines.schema["parts"].dataType.names if c in raw.columns]
    inside = T.StructType([f for f in columns if f.name not in folders])
    if has_header:
        heads = found.where("is_first").select(delimited.tokens(F.col("record"), delimiter[:1]).alias("names"))
        expected = "\n".join(inside.fieldNames()).lower()
        other = heads.where(F.lower(F.array_join("names", "\n")) != expected).first()
        if other is not None:
            raise ValueError(f"a file has the header {other['names']}, not {inside.fieldNames()}")
        found = found.where(~F.col("is_first"))
    options = {**CSV_OPTIONS, "sep": delimiter[:1], "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    parsed = found.select("parts", F.from_csv("record", _ddl(_with_corrupt(inside)), options).alias("row"))
    held = [F.col("parts" if c in folders else "row").getField(c).cast(raw.schema[c].dataType).alias(c) for c in raw.columns]
    return errors.mark(whole.unionByName(parsed.select(*held)), _csv_error(names[0])).drop(CORRUPT)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def _with_corrupt(columns: T.StructType) -> T.StructType:
    return T.StructType([*columns.fields, T.StructField(CORRUPT, T.StringType(), True)])


def _csv_error(first_column: str) -> Column:
    """Mismatch where Spark kept the raw line.

    Spark refuses a query that reads nothing but the raw-line column, so the test
    also mentions a data column.
    """
    touched = F.concat(F.coalesce(F.col(first_column).cast("string"), F.lit("")), F.col(CORRUPT))
    return F.when(touched.isNotNull(), F.lit(errors.SCHEMA_MISMATCH))


def read_avro(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Container files, one event per record; needs Spark's external Avro module."""
    try:
        return spark.read.format("avro").load(_paths(paths))
    except Exception as failure:  # the module is a separate artifact
        raise RuntimeError("reading avro needs the spark-avro package on the classpath") from failure


def file_paths(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of every file under a folder; no file is read."""
    with listing(spark):
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")


def extensions_under(spark: SparkSession, root: str) -> dict[str, int | str | None]:
    """File counts: per known extension, ``none`` and ``other`` with one example.

    Lists names only, file contents are not read; the answer is one row.
    """
    found = file_paths(spark, root).select(F.regexp_extract("path", r"\.([^./]+)$", 1).alias("x"))
    unknown = ~F.col("x").isin("", *EXTENSIONS)
    return (
        found.agg(
            *[F.count_if(F.col("x") == e).alias(e) for e in EXTENSIONS],
            F.count_if(F.col("x") == "").alias("none"),
            F.count_if(unknown).alias("other"),
            F.min(F.when(unknown, F.col("x"))).alias("example"),
        )
        .first()
        .asDict()
    )


def read_objects(
    spark: SparkSession, root: str, *, has_header: bool = True, delimiter: str = ","
) -> DataFrame:
    """A mixed folder as (path, data VARIANT): documents by extension.

    Files with another extension are reported and skipped; a file without any
    extension is an error.
    """
    found = extensions_under(spark, root)
    if found["none"]:
        raise ValueError(f"{found['none']} files under {root} have no extension")
    if found["other"]:
        log.warning("skipping %d files with unsupported extensions, such as %s", found["other"], found["example"])
    parts = []
    if found["json"]:
        parts.append(read_json_docs(spark, root))
    if found["csv"]:
        parts.append(_csv_objects(spark, root, has_header, delimiter))
    if found["avro"]:
        avro = read_avro(spark, root)
        parts.append(
            avro.select(
                F.col("_metadata.file_path").alias("path"),
                F.to_variant_object(F.struct(*avro.columns)).alias("data"),
                F.lit(None).cast("string").alias("_error"),
            )
        )
    if not parts:
        raise ValueError(f"no readable files under {root}")
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


# Kinds of values, from narrow to wide, and the texts that are of each.  A column has the
# first kind that all its sampled values are of.
KINDS = ("bigint", "double", "boolean", "date", "timestamp", "string")
_DAY = r"\d{4}-\d{2}-\d{2}"
_FORMS = {
    "bigint": r"^[+-]?\d{1,19}$",
    "double": r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?Inf(inity)?)$",
    "boolean": r"^(?i:true|false)$",
    "date": rf"^{_DAY}$",
    "timestamp": rf"^{_DAY}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,6}})?)?(Z|[+-]\d{{2}}:\d{{2}})?)?$",
}


def _fits(token: Column, kind: str) -> Column:
    if kind == "string":
        return F.lit(True)
    return F.rlike(token, F.lit(_FORMS[kind])) & token.try_cast(kind).isNotNull()


def _kinds_of(token: Column) -> Column:
    """One bit for each kind that a text is of."""
    bits = F.lit(0)
    for place, kind in enumerate(KINDS):
        bits = bits + F.when(_fits(token, kind), 1 << place).otherwise(0)
    return bits


def _typed_value(token: Column, kind: Column) -> Column:
    """A text as a VARIANT of a kind given by its number; null where it does not fit."""
    out = token.cast("variant")
    for place, name in enumerate(KINDS[:-1]):
        out = F.when(kind == place, F.when(_fits(token, name), token.try_cast(name)).cast("variant")).otherwise(out)
    return out


def csv_headers(found: DataFrame, has_header: bool, delimiter: str) -> tuple[DataFrame, DataFrame]:
    """(``file, header``; ``header, names, kinds, repeats``) of records, both stored.

    Names come from each file's first record and kinds from the first 100 records of
    every file with that header: one aggregation over headers and columns, however many
    headers there are.  ``repeats`` marks headers that name a column twice.
    """
    first = Window.partitionBy("file").orderBy("block", "place")
    head = found.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= INFER_RECORDS + int(has_header))
    head = materialize(head.select("file", "_n", delimited.tokens(F.col("record"), delimiter).alias("values")), "csv-head")
    standing = lambda v, i: F.coalesce(v if has_header else F.lit(None).cast("string"), F.concat(F.lit("_c"), i.cast("string")))
    names = F.transform("values", standing)
    files = materialize(head.where("_n = 1").select("file", names.alias("names"), F.to_json(names).alias("header")), "csv-files")
    sampled = head.where(F.col("_n") > int(has_header)).join(files.select("file", "header"), "file")
    values = sampled.select("header", F.posexplode("values").alias("at", "value")).where(F.col("value").isNotNull())
    columns = values.groupBy("header", "at").agg(F.bit_and(_kinds_of(F.col("value"))).alias("bits"))
    narrowest = F.coalesce(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, i) for i in range(len(KINDS))])
    kinds = columns.select("header", "at", narrowest.alias("kind")).groupBy("header").agg(F.map_from_entries(F.collect_list(F.struct("at", "kind"))).alias("found"))
    known = files.groupBy("header").agg(F.first("names").alias("names")).join(kinds, "header", "left")
    string = F.lit(len(KINDS) - 1)
    kind_of = F.transform("names", lambda _, i: F.coalesce(F.try_element_at("found", i), string))
    repeats = F.size(F.array_distinct("names")) < F.size("names")
    headers = materialize(known.select("header", "names", kind_of.alias("kinds"), repeats.alias("repeats")), "csv-headers")
    return files.select("file", "header"), headers


def _csv_objects(spark: SparkSession, paths: str | list[str], has_header: bool, delimiter: str) -> DataFrame:
    """Rows of delimited files, each by its own header, in one read.

    Headers are data: a stored table that records are joined with through their file.  A
    header that names a column twice marks the rows of its own files; a record with more
    or fewer values than its header, or with a value of another kind, marks itself.
    """
    only_csv = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
    delimiter = delimiter[:1]
    lines = delimited.text_lines(spark, _paths(paths), options=only_csv)
    found = delimited.records(lines, delimited.split_states(lines, delimiter), delimiter)
    files, headers = csv_headers(found, has_header, delimiter)
    rows = found.where(~F.col("is_first")) if has_header else found
    rows = rows.join(delimited.small(files), "file").join(delimited.small(headers), "header")
    rows = rows.withColumn("values", delimited.tokens(F.col("record"), delimiter))
    typed = F.transform("kinds", lambda kind, i: _typed_value(F.get("values", i), kind))
    rows = rows.withColumn("typed", F.when(~F.col("repeats"), typed))
    misfit = F.exists(F.sequence(F.lit(0), F.size("names") - 1), lambda i: F.get("values", i).isNotNull() & F.get("typed", i).isNull())
    bad = F.col("repeats") | (F.size("values") != F.size("names")) | misfit
    return errors.mark(
        rows.select(
            F.col("file").alias("path"),
            F.when(~F.col("repeats"), F.to_variant_object(F.map_from_arrays("names", "typed"))).alias("data"),
            bad.alias("_bad"),
        ),
        F.when(F.col("_bad"), F.lit(errors.SCHEMA_MISMATCH)),
    ).drop("_bad")


def object_path(url: str) -> str:
    """Drop scheme and host from a URL: ``s3://bucket/a/b`` → ``/a/b``."""
    scheme, separator, rest = url.partition("://")
    if not separator:
        return url
    return "/" + rest.partition("/")[2]


_SCHEME = r"^[A-Za-z][\w+.-]*:(?://[^/]*)?"


def _place_under(path: Column, base: str) -> Column:
    """A path or URL relative to a folder, with one leading slash."""
    bare = F.regexp_replace(path, _SCHEME, "")
    inside = F.when(F.startswith(bare, F.lit(base + "/")), F.substring(bare, F.lit(len(base) + 1), F.length(bare))) if base else bare
    return F.concat(F.lit("/"), F.ltrim(F.coalesce(inside, bare), F.lit("/")))


def _decoded(path: Column) -> Column:
    """File paths as metadata has them are URL-encoded."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def _literal(path: str) -> str:
    """A path that the reader takes as it stands, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def wanted_paths(spark: SparkSession, root: str, wanted: DataFrame) -> list[str] | None:
    """Paths of the files under ``root`` that ``wanted`` (``_path``) names; None if they
    are more than NAMED_PATHS.  A join with the listing: no file is opened."""
    base = re.sub(_SCHEME, "", root).rstrip("/")
    listed = file_paths(spark, root).withColumn("_path", _place_under(F.col("path"), base))
    met = listed.join(wanted.select("_path").distinct(), "_path", "left_semi").select("path")
    rows = met.limit(NAMED_PATHS + 1).collect()
    return None if len(rows) > NAMED_PATHS else sorted(row["path"] for row in rows)


def read_from_events(
    spark: SparkSession,
    events: DataFrame,
    path_template: str,
    *,
    name: str,
    root: str,
    has_header: bool = True,
    delimiter: str = ",",
) -> DataFrame:
    """Read what each event points to: one output event per document or row.

    The path is rendered per event and taken relative to ``root``, with or without a
    leading slash.  The listing of ``root`` is joined with the wanted paths, and the
    files found are read by name: what is read follows what is wanted, not what the
    folder holds.  Beyond NAMED_PATHS of them the folder is read and joined instead.  An
    event stays, marked, if its file is missing, has no extension, or one without a
    reader.
    """
    base = re.sub(_SCHEME, "", root).rstrip("/")
    wanted = events.withColumn("_path", _place_under(render(path_template, events), base))
    paths = wanted_paths(spark, root, wanted)
    parts = []
    for extension, read in (
        ("json", lambda p: read_json_docs(spark, p)),
        ("csv", lambda p: _csv_objects(spark, p, has_header, delimiter)),
    ):
        if paths is None:
            parts.append(read(root))
        elif own := [_literal(p) for p in paths if p.endswith(f".{extension}")]:
            parts.append(read(own))
    documents = parts[0] if parts else spark.createDataFrame([], f"path string, data variant, {ERROR} string")
    for part in parts[1:]:
        documents = documents.unionByName(part)
    documents = documents.select(
        _place_under(_decoded(F.col("path")), base).alias("_file"),
        F.col("data").alias("_data"),
        F.col(ERROR).alias("_read_error"),
        F.lit(True).alias("_read"),
    )
    joined = wanted.join(documents, F.col("_path") == F.col("_file"), "left")
    extension = F.regexp_extract("_path", r"\.([^./]+)$", 1)
    missed = (
        F.when(F.col("_path").isNull(), F.lit(errors.NOT_FOUND))
        .when(extension == "", F.lit(errors.NO_EXTENSION))
        .when(~extension.isin("json", "csv"), F.lit(errors.UNSUPPORTED_EXTENSION))
        .otherwise(F.lit(errors.NOT_FOUND))
    )
    return joined.select(
        F.col("_data").alias("data"),
        F.lit(name).alias("subject"),
        F.lit(None).cast("string").alias("id"),
        "timestamp",
        "task_id",
        F.lit("object_store_reader").alias("task_type"),
        F.col("_path").alias("path"),
        F.when(F.col("_read"), F.col("_read_error")).otherwise(missed).alias(ERROR),
    )
