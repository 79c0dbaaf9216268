"""Queries over landing, layout, receipts and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.envelope import ERROR
from ..session import scratch_path
from ..sinks.export import DELIMITERS, bulk_export
from ..sinks.files import DATE_PARTITIONS, object_name, templated_path, with_event_date, write_events, write_receipts
from ..sources.files import read_csv_typed, read_json_lines
from ..sources.tables import event_envelope, table
from .registry import query


@query("write_roundtrip_csv", "SELECT event_id, user_id, event_type, value FROM events")
def roundtrip_csv(spark, sf_dir):
    path = scratch_path(spark, "landed-csv")
    events = event_envelope(spark, sf_dir, F.struct("event_id", "user_id", "event_type", "value"))
    write_events(events, path, "csv")
    rows = read_csv_typed(spark, path)
    return rows.where(F.col(ERROR).isNull()).drop(ERROR)


@query(
    "write_roundtrip_json",
    """
SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent
FROM events
""",
)
def roundtrip_json(spark, sf_dir):
    path = scratch_path(spark, "landed-json")
    payload = F.struct("event_id", "event_type", "value", "k", F.lit(None).cast("string").alias("absent"))
    write_events(event_envelope(spark, sf_dir, payload), path, "json")
    rows = read_json_lines(spark, path, "event_id bigint, event_type string, value double, k bigint, absent string")
    return rows.where(F.col(ERROR).isNull()).select("data.*")


@query(
    "csv_text_roundtrip",
    """
SELECT 'document' AS kind, doc_id AS id, length(text) AS n_chars, md5(text) AS digest FROM documents
UNION ALL
SELECT 'page', page_id, length(html), md5(html) FROM pages
""",
)
def csv_text(spark, sf_dir):
    """Whole texts and pages, with their quotes, delimiters and line ends, there and back."""
    parts = []
    for kind, id, text in (("document", "doc_id", "text"), ("page", "page_id", "html")):
        path = scratch_path(spark, "landed-text")
        rows = table(spark, sf_dir, f"{kind}s").select(F.struct(F.col(id).alias("id"), F.col(text).alias("text")).alias("data"))
        write_events(rows, path, "csv")
        back = read_csv_typed(spark, path).where(F.col(ERROR).isNull())
        parts.append(
            back.select(
                F.lit(kind).alias("kind"), "id", F.length("text").cast("bigint").alias("n_chars"),
                F.md5(F.col("text").cast("binary")).alias("digest"),
            )
        )
    return parts[0].unionByName(parts[1])


_BY_DAY = """
SELECT year(ts) AS "year", month(ts) AS "month", day(ts) AS "day", count(*) AS n_events,
       max(event_id) AS last_event
FROM events GROUP BY 1, 2, 3
"""


@query("hive_partition_layout", _BY_DAY)
def partition_layout(spark, sf_dir):
    """Land by event date, then read the counts back from the layout."""
    path = scratch_path(spark, "landed-days")
    dated = with_event_date(event_envelope(spark, sf_dir))
    write_events(dated, path, "parquet", partition_by=list(DATE_PARTITIONS))
    landed = spark.read.parquet(path)
    return landed.groupBy(*[F.col(p).cast("bigint").alias(p) for p in DATE_PARTITIONS]).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("event_id").alias("last_event")
    )


@query(
    "templated_path",
    """
SELECT '/landing/events.' || event_type || '/' || CAST(user_id % 4 AS VARCHAR) AS path, count(*) AS n_events
FROM events GROUP BY 1
""",
)
def path_per_row(spark, sf_dir):
    payload = F.struct("event_id", (F.col("user_id") % 4).alias("shard"))
    events = event_envelope(spark, sf_dir, payload)
    place = scratch_path(spark, "landed-paths")
    path = templated_path("s3://bucket/landing/{{event.subject}}/{{event.data.shard}}", events)
    write_events(events.withColumn("destination", path), place, "json", partition_by=["destination"])
    landed = read_json_lines(spark, place, "event_id bigint, shard bigint")
    return landed.groupBy(F.col("destination").alias("path")).agg(F.count(F.lit(1)).alias("n_events"))


@query(
    "object_name",
    """
SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(epoch_us(ts) AS VARCHAR)
                      ELSE CAST(event_id AS VARCHAR) END || '.json' AS object_name
FROM events
""",
)
def name_of_object(spark, sf_dir):
    events = event_envelope(spark, sf_dir)
    some = events.withColumn("id", F.when(F.col("data.event_type") != "view", F.col("id")))
    return some.select("data.event_id", object_name("json").alias("object_name"))


@query(
    "write_receipts",
    """
SELECT 'success' AS status, 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts) AS partition, count(*) AS rows,
       sum(length(to_json({'event_id': event_id, 'event_type': event_type})) + 1)::BIGINT AS bytes, true AS named, true AS tagged
FROM events GROUP BY 2
""",
)
def receipts_of_write(spark, sf_dir):
    """Receipts per file, summed per partition folder so they can be compared."""
    path = scratch_path(spark, "receipts")
    dated = with_event_date(event_envelope(spark, sf_dir, F.struct("event_id", "event_type")))
    write_events(dated, path, "json", partition_by=list(DATE_PARTITIONS))
    receipts = write_receipts(spark, path, "json")
    folder = F.regexp_extract("path", r"(year=\d+/month=\d+/day=\d+)/", 1)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return receipts.groupBy("status", folder.alias("partition")).agg(
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.bool_and(F.startswith(name, F.lit("part-"))).alias("named"),
        (F.countDistinct("e_tag") == F.count("path")).alias("tagged"),
    )


def _export(spark, sf_dir, operation, delimiter, line_ending):
    path = scratch_path(spark, "export")
    customers = table(spark, sf_dir, "customer").withColumn("is_deleted", F.col("c_acctbal") < 0)
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    bulk_export(customers, path, columns, operation=operation, delimiter=delimiter, line_ending=line_ending)
    rows = read_csv_typed(spark, path, delimiter=DELIMITERS[delimiter])
    return rows.where(F.col(ERROR).isNull()).drop(ERROR)


@query(
    "bulk_export_live",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer WHERE NOT (c_acctbal < 0)",
)
def export_live(spark, sf_dir):
    return _export(spark, sf_dir, "query", "PIPE", "CRLF")


@query(
    "bulk_export_all",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer",
)
def export_all(spark, sf_dir):
    return _export(spark, sf_dir, "queryAll", "TAB", "LF")


@query(
    "bulk_export_delimiters",
    """
SELECT d AS delimiter, c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM customer, (VALUES ('COMMA'), ('TAB'), ('SEMICOLON'), ('PIPE'), ('CARET'), ('BACKQUOTE')) AS v(d)
WHERE NOT (c_acctbal < 0)
""",
)
def export_delimiters(spark, sf_dir):
    """Every column delimiter, there and back."""
    parts = [
        _export(spark, sf_dir, "query", name, "LF").withColumn("delimiter", F.lit(name)) for name in DELIMITERS
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
