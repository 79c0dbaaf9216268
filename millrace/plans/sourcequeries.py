"""Queries over schedules, files, message payloads and request logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.auth import Credentials
from ..operators.convert import batch_to_json
from ..operators.envelope import ERROR, micros
from ..operators.iterate import iterate
from ..operators.requests import parse_responses, publish_records, render_requests
from ..session import scratch_path
from ..sinks.files import write_events, write_receipts
from ..sources.files import file_paths, read_csv_typed, read_from_events, read_json_docs, read_objects
from ..sources.messages import decode_payload
from ..sources.requests import ingest_requests
from ..sources.schedule import interval_run_of, interval_schedule, run_windows, cron_schedule, with_cron_run
from ..sources.tables import event_envelope, event_rows, table
from .registry import query

_SPAN = """
span AS (SELECT CAST(floor(min(epoch_us(ts)) / 1e6) AS BIGINT) AS lo,
                CAST(floor(max(epoch_us(ts)) / 1e6) AS BIGINT) AS hi FROM events)
"""


def _event_seconds(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    seconds = F.floor(micros(rows, "ts") / 1_000_000)
    return rows.select("event_id", "k", seconds.alias("sec"))


def _span(rows):
    found = rows.agg(F.min("sec").alias("lo"), F.max("sec").alias("hi")).first()
    return found["lo"], found["hi"]


@query(
    "schedule_interval",
    f"""
WITH {_SPAN},
ticks AS (SELECT i AS run, lo + i * 21600 AS scheduled_at
          FROM span, generate_series(0, (hi - lo) // 21600 + 1) AS g(i)),
runs AS (SELECT lo + CAST(ceil((floor(epoch_us(ts) / 1e6) - lo) / 21600) AS BIGINT) * 21600 AS scheduled_at, count(*) AS n
         FROM events, span GROUP BY 1)
SELECT run, scheduled_at, coalesce(n, 0) AS n_events
FROM ticks LEFT JOIN runs USING (scheduled_at)
""",
)
def schedule_interval(spark, sf_dir):
    """Six-hourly ticks over the events' span, each with the rows its run handles."""
    rows = _event_seconds(spark, sf_dir)
    lo, hi = _span(rows)
    ticks = interval_schedule(spark, lo, "6h", end=hi + 21_600)
    runs = rows.groupBy(interval_run_of(F.col("sec"), lo, "6h").alias("scheduled_at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return ticks.join(runs, "scheduled_at", "left").select(
        "run", "scheduled_at", F.coalesce("n", F.lit(0)).alias("n_events")
    )


_CRON_FIRES = """
fires AS (
  SELECT epoch_us(m) // 1000000 AS fire
  FROM span, generate_series(date_trunc('minute', make_timestamp(lo * 1000000)),
                             make_timestamp((hi + 8 * 86400) * 1000000), INTERVAL 1 MINUTE) AS g(m)
  WHERE extract(minute FROM m) IN (0, 30) AND extract(hour FROM m) BETWEEN 8 AND 17
    AND extract(dow FROM m) BETWEEN 1 AND 5)
"""


@query(
    "schedule_cron",
    f"""
WITH {_SPAN}, {_CRON_FIRES}
SELECT f.fire AS scheduled_at, count(*) AS n_events, max(e.event_id) AS last_event
FROM (SELECT event_id, CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS sec FROM events) e
ASOF JOIN fires f ON e.sec < f.fire
GROUP BY 1
""",
)
def schedule_cron(spark, sf_dir):
    """Every event's next half-hourly fire in business hours, strictly after it."""
    rows = _event_seconds(spark, sf_dir)
    lo, hi = _span(rows)
    assigned = with_cron_run(rows, "sec", "*/30 8-17 * * MON-FRI", lo, hi)
    return assigned.groupBy("scheduled_at").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("event_id").alias("last_event")
    )


@query(
    "run_windows",
    f"""
WITH {_SPAN},
fires AS (
  SELECT epoch_us(m) // 1000000 AS fire
  FROM span, generate_series(date_trunc('minute', make_timestamp(lo * 1000000)),
                             make_timestamp((hi + 3 * 86400) * 1000000), INTERVAL 1 MINUTE) AS g(m)
  WHERE extract(minute FROM m) = 15 AND extract(hour FROM m) IN (0, 6, 12, 18)),
runs AS (
  SELECT fire AS scheduled_at, lag(fire) OVER (ORDER BY fire) AS last_run_time,
         lead(fire) OVER (ORDER BY fire) AS next_run_time
  FROM fires, span WHERE fire > lo),
kept AS (SELECT runs.* FROM runs, span WHERE scheduled_at <= hi),
n AS (SELECT f.fire AS scheduled_at, count(*) AS n_events
      FROM (SELECT CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS sec FROM events) e
      ASOF JOIN fires f ON e.sec < f.fire GROUP BY 1)
SELECT scheduled_at, last_run_time, next_run_time, 'nightly load' AS message, coalesce(n_events, 0) AS n_events
FROM kept LEFT JOIN n USING (scheduled_at)
""",
)
def windows_of_runs(spark, sf_dir):
    """Run messages of a cron schedule with the rows that fall into each window."""
    rows = _event_seconds(spark, sf_dir)
    lo, hi = _span(rows)
    expression = "15 */6 * * *"
    runs = run_windows(cron_schedule(spark, expression, lo, end=hi), "nightly load")
    handled = with_cron_run(rows, "sec", expression, lo, hi).groupBy("scheduled_at").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return runs.join(handled, "scheduled_at", "left").withColumn(
        "n_events", F.coalesce("n_events", F.lit(0))
    )


def _order_documents(spark, sf_dir):
    """Orders in documents of 1,000: one JSON array per document."""
    orders = table(spark, sf_dir, "orders")
    return batch_to_json(
        orders,
        F.floor(F.col("o_orderkey") / 1000),
        F.struct("o_orderkey", "o_custkey", "o_orderstatus"),
        order_by="o_orderkey",
    )


def _by_part(rows):
    """Writer of a file for each ``part``, dealt over all cores: adaptive execution would
    merge partitions of few bytes, and one task would write every file."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "part").write.partitionBy("part")


def _write_documents(spark, sf_dir) -> str:
    """One file per document, named by Spark, under a fresh folder."""
    path = scratch_path(spark, "documents")
    text = F.concat(F.lit('{"document":'), F.col("batch_id").cast("string"), F.lit(',"orders":'), "data", F.lit("}"))
    document = "document bigint, orders array<struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>>"
    documents = _order_documents(spark, sf_dir).select(F.from_json(text, document).alias("d"), F.col("batch_id").alias("part"))
    _by_part(documents.select("d.*", "part")).json(path)
    return path


def _order_rows(events):
    """Orders out of ``{"document": n, "orders": [...]}`` payloads."""
    spread = iterate(events, "orders")
    return spread.where(F.col(ERROR).isNull()).select(
        F.variant_get("data", "$.o_orderkey", "bigint").alias("o_orderkey"),
        F.variant_get("data", "$.o_custkey", "bigint").alias("o_custkey"),
        F.variant_get("data", "$.o_orderstatus", "string").alias("o_orderstatus"),
    )


def _as_events(documents):
    return documents.where(F.col(ERROR).isNull()).select(
        "data", F.col("path").alias("subject"), F.lit(None).cast("string").alias("id")
    )


_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"


@query("read_json_docs", _ORDERS_SQL)
def json_documents(spark, sf_dir):
    """Write orders as whole documents, read one event per file, fan out."""
    return _order_rows(_as_events(read_json_docs(spark, _write_documents(spark, sf_dir))))


@query("read_csv_typed", "SELECT event_id, user_id, event_type, value FROM events")
def csv_typed(spark, sf_dir):
    """Types come from the first 100 records; integers are 64-bit."""
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value").write.option(
        "header", True
    ).option("sep", ";").csv(path)
    rows = read_csv_typed(spark, path, delimiter=";")
    return rows.where(F.col(ERROR).isNull()).drop(ERROR)


def _note(quote, break_one, break_two):
    """A value with quotes, commas and both kinds of line ends, in SQL of either engine."""
    return f"CASE WHEN event_id % 3 = 0 THEN 'line ' || event_id || {break_one} || '{quote}' || event_type || '{quote}, x' || {break_two} || 'end' ELSE event_type END"


@query("read_quoted_csv", f"""SELECT event_id, {_note('"', 'chr(10)', 'chr(13) || chr(10)')} AS note, value FROM events""")
def quoted_csv(spark, sf_dir):
    """Every third value goes over three lines; files are read in splits all the same."""
    path = scratch_path(spark, "quoted-csv")
    note = F.expr(_note('"', "char(10)", "char(13) || char(10)"))
    rows = table(spark, sf_dir, "events").select(F.struct("event_id", note.alias("note"), "value").alias("data"))
    write_events(rows, path, "csv")
    back = read_csv_typed(spark, path)
    return back.where(F.col(ERROR).isNull()).drop(ERROR)


def _write_mixed_headers(spark, sf_dir) -> str:
    """Twenty files with headers of their own: every fifth names a column over two lines,
    one names a column twice; and a file with nothing in it."""
    root = scratch_path(spark, "headers")
    parts = spark.range(20).select(F.col("id").alias("part"))
    first = F.when(F.col("part") % 5 == 0, F.lit('id,"kind')).when(F.col("part") == 7, F.lit("id,kind,id")).otherwise(
        F.concat(F.lit("id,kind_"), F.col("part"), F.lit(",k"))
    )
    headers = parts.select("part", F.lit(0).cast("long").alias("at"), first.alias("line")).unionByName(
        parts.where("part % 5 = 0").select("part", F.lit(1).cast("long").alias("at"), F.concat("part", F.lit('",k')).alias("line"))
    )
    line = F.concat_ws(",", "event_id", "event_type", "k")
    rows = event_rows(spark, sf_dir).select((F.col("event_id") % 20).alias("part"), (F.col("event_id") + 2).alias("at"), line.alias("line"))
    # Lines as they are: no character of theirs is special to this writer.
    raw = {"sep": "\u0001", "quote": "\u0002", "escape": "\u0003"}
    lines = headers.unionByName(rows).repartition("part").sortWithinPartitions("part", "at").select("part", "line")
    lines.write.partitionBy("part").options(**raw).csv(f"{root}/files")
    lines.limit(0).select("line").write.options(**raw).csv(f"{root}/empty")
    return root


@query(
    "read_mixed_headers",
    """
SELECT event_id % 20 AS part, count(*) AS n_rows, count(CASE WHEN event_id % 20 = 7 THEN 1 END) AS n_errors,
       CAST(sum(CASE WHEN event_id % 20 <> 7 THEN event_id END) AS BIGINT) AS ids,
       max(CASE WHEN event_id % 20 <> 7 THEN event_type END) AS label,
       max(CASE WHEN event_id % 20 = 7 THEN NULL WHEN event_id % 5 = 0 THEN 'kind' || chr(10) || event_id % 20 ELSE 'kind_' || event_id % 20 END) AS name
FROM events GROUP BY 1
""",
)
def mixed_headers(spark, sf_dir):
    """A folder in which every file has its own header, read once."""
    objects = read_objects(spark, _write_mixed_headers(spark, sf_dir))
    members = F.try_variant_get("data", "$", "map<string,variant>")
    kind = F.map_filter(members, lambda name, _: F.startswith(name, F.lit("kind")))
    rows = objects.select(
        F.regexp_extract("path", r"part=(\d+)/", 1).cast("bigint").alias("part"),
        F.try_variant_get("data", "$.id", "bigint").alias("id"),
        F.element_at(F.map_keys(kind), 1).alias("name"),
        F.try_variant_get(F.element_at(F.map_values(kind), 1), "$", "string").alias("label"),
        F.col(ERROR).isNotNull().alias("failed"),
    )
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("failed").alias("n_errors"), F.sum("id").alias("ids"), F.max("label").alias("label"), F.max("name").alias("name")
    )


@query(
    "read_by_extension",
    """
SELECT 'csv' AS extension, event_id AS record, event_type AS label FROM events
UNION ALL
SELECT 'json', o_orderkey // 1000, CAST(count(*) AS VARCHAR) FROM orders GROUP BY 2
""",
)
def by_extension(spark, sf_dir):
    """A folder of JSON documents, CSV batches and text files that are skipped."""
    root = scratch_path(spark, "mixed")
    table(spark, sf_dir, "events").select("event_id", "event_type").write.option("header", True).csv(
        f"{root}/batches"
    )
    documents = _order_documents(spark, sf_dir).select(F.col("batch_id").alias("document"), "n_rows", F.col("batch_id").alias("part"))
    _by_part(documents).json(f"{root}/documents")
    table(spark, sf_dir, "region").select("r_name").write.text(f"{root}/notes")
    objects = read_objects(spark, root)
    extension = F.regexp_extract("path", r"\.([^./]+)$", 1)
    return objects.select(
        extension.alias("extension"),
        F.coalesce(
            F.try_variant_get("data", "$.event_id", "bigint"), F.try_variant_get("data", "$.document", "bigint")
        ).alias("record"),
        F.coalesce(
            F.try_variant_get("data", "$.event_type", "string"), F.try_variant_get("data", "$.n_rows", "string")
        ).alias("label"),
    )


@query("read_from_events", _ORDERS_SQL)
def from_events(spark, sf_dir):
    """Receipts of written documents drive the reads."""
    path = _write_documents(spark, sf_dir)
    receipts = write_receipts(spark, path, "json")
    triggers = receipts.select(
        F.struct("path").alias("data"),
        F.lit("receipts").alias("subject"),
        F.col("e_tag").alias("id"),
        F.lit(0).cast("bigint").alias("timestamp"),
        F.lit(0).alias("task_id"),
        F.lit("object_store_writer").alias("task_type"),
    )
    documents = read_from_events(spark, triggers, "{{event.data.path}}", name="reader", root=path)
    return _order_rows(documents)


@query(
    "read_wanted_files",
    """
SELECT 'csv' AS kind, event_id AS record, event_type AS label FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT DISTINCT 'json', o_orderkey // 1000, NULL FROM orders WHERE o_orderkey // 1000 % 2 = 0
UNION ALL
SELECT 'error', n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'NotFound' WHEN 1 THEN 'UnsupportedExtension' ELSE 'NoExtension' END FROM nation
""",
)
def wanted_files(spark, sf_dir):
    """Events that point to some CSV and JSON files of a folder, and to files it lacks."""
    root = scratch_path(spark, "wanted")
    events = table(spark, sf_dir, "events")
    events.select("event_id", "event_type", F.col("event_type").alias("part")).write.partitionBy("part").option("header", True).csv(f"{root}/rows")
    orders = table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 1000).alias("document")).distinct()
    _by_part(orders.withColumn("part", F.col("document"))).json(f"{root}/documents")
    listed = file_paths(spark, root).select(F.substring_index("path", root.rpartition("/")[2], -1).alias("f"))
    part = F.regexp_extract("f", "part=([^/]+)/", 1)
    some = listed.where(part.isin("click", "view") | (F.startswith("f", F.lit("/documents")) & (part.try_cast("int") % 2 == 0)))
    key = F.col("n_nationkey")
    name = F.concat(F.lit("gone-"), key, F.when(key % 3 == 0, ".csv").when(key % 3 == 1, ".txt").otherwise(""))
    # With a leading slash and without one.
    pointers = some.unionByName(table(spark, sf_dir, "nation").select(name.alias("f")))
    triggers = pointers.select(
        F.struct("f").alias("data"), F.lit("pointers").alias("subject"), F.lit(None).cast("string").alias("id"),
        F.lit(0).cast("bigint").alias("timestamp"), F.lit(0).alias("task_id"), F.lit("pointer").alias("task_type"),
    )
    found = read_from_events(spark, triggers, "{{event.data.f}}", name="reader", root=root)
    missing = F.col(ERROR).isNotNull()
    return found.select(
        F.when(missing, "error").when(F.col("path").endswith(".csv"), "csv").otherwise("json").alias("kind"),
        F.when(missing, F.regexp_extract("path", r"gone-(\d+)", 1).try_cast("bigint"))
        .otherwise(F.coalesce(F.try_variant_get("data", "$.event_id", "bigint"), F.try_variant_get("data", "$.document", "bigint")))
        .alias("record"),
        F.when(missing, F.col(ERROR)).otherwise(F.try_variant_get("data", "$.event_type", "string")).alias("label"),
    )


_AUTH = Credentials(bearer="token-1", username="svc", password="s3cret:x")


@query(
    "request_ingest",
    """
WITH r AS (
  SELECT *, (conv_id + turn) % 3 AS body_kind,
    CASE turn % 8
      WHEN 0 THEN NULL
      WHEN 1 THEN 'NoCredentials'
      WHEN 2 THEN 'MalformedCredentials'
      WHEN 3 THEN NULL
      WHEN 4 THEN 'InvalidCredentials'
      WHEN 5 THEN 'MalformedCredentials'
      WHEN 6 THEN 'InvalidCredentials'
      ELSE 'InvalidCredentials' END AS auth_error
  FROM conversations)
SELECT conv_id, turn, auth_error,
       CASE WHEN auth_error IS NOT NULL THEN 401 WHEN body_kind = 1 THEN 400 ELSE 200 END AS status,
       CASE WHEN auth_error IS NULL AND body_kind <> 1 THEN 'req-' || conv_id END AS request_id,
       CASE WHEN auth_error IS NULL AND body_kind <> 1 THEN 1 END AS n_headers,
       CASE WHEN auth_error IS NULL AND body_kind = 2 THEN text END AS payload_text
FROM r
""",
)
def request_ingest(spark, sf_dir):
    """Request log from conversations: every authentication case, three kinds of body."""
    rows = table(spark, sf_dir, "conversations")
    case = F.col("turn") % 8
    authorization = (
        F.when(case == 0, F.lit("Bearer token-1"))
        .when(case == 2, F.lit("Bearer tokén"))
        .when(case == 3, F.concat(F.lit("Basic "), F.base64(F.lit("svc:s3cret:x").cast("binary"))))
        .when(case == 4, F.lit("Bearer other"))
        .when(case == 5, F.lit("Basic not*base64"))
        .when(case == 6, F.concat(F.lit("Basic "), F.base64(F.lit("svc:wrong").cast("binary"))))
        .when(case == 7, F.lit("Digest something"))
    )
    headers = F.map_filter(
        F.create_map(
            F.lit("Authorization"), authorization,
            # The same name in other letters: the later one counts.
            F.lit("X-REQUEST-ID"), F.lit("stale"),
            F.lit("X-Request-Id"), F.concat(F.lit("req-"), F.col("conv_id").cast("string")),
            F.lit("user-agent"), F.lit("agent/1"),
        ),
        lambda _, v: v.isNotNull(),
    )
    body_kind = (F.col("conv_id") + F.col("turn")) % 3
    body = (
        F.when(body_kind == 0, F.lit(""))
        .when(body_kind == 1, F.concat(F.lit("{broken "), "text"))
        .otherwise(F.to_json(F.struct("text", "role")))
    )
    requests = rows.select("conv_id", "turn", headers.alias("headers"), body.alias("body"))
    judged = ingest_requests(requests, credentials=_AUTH, allow_headers=["x-request-id"])
    return judged.select(
        "conv_id", "turn", "auth_error", "status",
        F.element_at("data.headers", F.lit("x-request-id")).alias("request_id"),
        F.when(F.col("data").isNotNull(), F.size("data.headers")).alias("n_headers"),
        F.try_variant_get("data.payload", "$.text", "string").alias("payload_text"),
    )


@query(
    "decode_payload",
    """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'm-' || event_id END AS id,
       CASE event_id % 4 WHEN 1 THEN 'undecoded' WHEN 3 THEN 'undecoded' ELSE 'json' END AS payload_kind,
       CASE event_id % 4 WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE event_id % 4 WHEN 2 THEN event_type END AS label
FROM events
""",
)
def decoded(spark, sf_dir):
    """Bytes that are a JSON object, a JSON string, plain text, or not UTF-8 at all."""
    rows = event_rows(spark, sf_dir)
    case = F.col("event_id") % 4
    payload = (
        F.when(case == 0, F.col("props").cast("binary"))
        .when(case == 1, F.concat(F.lit("k="), F.col("k").cast("string")).cast("binary"))
        .when(case == 2, F.concat(F.lit('"'), "event_type", F.lit('"')).cast("binary"))
        .otherwise(F.unhex(F.lit("FFFE00")))
    )
    headers = F.when(
        F.col("event_id") % 2 == 0,
        F.create_map(F.lit("Nats-Msg-Id"), F.concat(F.lit("m-"), F.col("event_id").cast("string"))),
    ).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    messages = rows.select("event_id", payload.alias("payload"), headers.alias("headers"))
    out = decode_payload(messages)
    return out.select(
        "event_id", "id", "payload_kind",
        F.try_variant_get("data", "$.k", "bigint").alias("k"),
        F.when(P.variant_kind(F.col("data")) == "STRING", F.try_variant_get("data", "$", "string")).alias("label"),
    )


@query(
    "request_render",
    """
SELECT event_id, 'POST' AS "method", 'https://api.example.com/users/' || user_id AS endpoint,
       'k-' || CAST(json_extract_string(props, '$.k') AS VARCHAR) AS trace,
       'kind=' || event_type || '&note=a+%26+b&k=' || json_extract_string(props, '$.k') AS form,
       '{"kind":"' || event_type || '","note":"a & b","k":"' || json_extract_string(props, '$.k') || '"}' AS json_body,
       'https://api.example.com/users/' || user_id || '?kind=' || event_type || '&note=a+%26+b&k='
         || json_extract_string(props, '$.k') AS query_endpoint
FROM events
""",
)
def request_render(spark, sf_dir):
    """The same payload as form, JSON body and query string."""
    events = event_envelope(spark, sf_dir)
    config = {
        "method": "POST",
        "endpoint": "https://api.example.com/users/{{event.data.user_id}}",
        "headers": {"x-trace": "k-{{event.data.k}}"},
        "payload": {
            "object": {"kind": "{{event.data.event_type}}", "note": "a & b", "k": "{{event.data.k}}"},
            "send_as": "UrlEncoded",
        },
    }

    def sent_as(encoding, rows):
        return render_requests(rows, {**config, "payload": {**config["payload"], "send_as": encoding}})

    form = sent_as("UrlEncoded", events).withColumnRenamed("body", "form")
    both = sent_as("Json", form.drop("method", "endpoint", "headers", ERROR)).withColumnRenamed("body", "json_body")
    every = sent_as("QueryParams", both.withColumnRenamed("endpoint", "plain_endpoint").drop("method", "headers", ERROR))
    return every.select(
        "data.event_id", "method", F.col("plain_endpoint").alias("endpoint"),
        F.element_at("headers", F.lit("x-trace")).alias("trace"),
        "form", "json_body", F.col("endpoint").alias("query_endpoint"),
    )


@query(
    "response_parse",
    """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 502 ELSE 200 END AS status,
       CASE WHEN event_id % 5 = 0 THEN 'STRING' ELSE 'OBJECT' END AS kind,
       CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 5 = 0 THEN '<html>' || event_type || '</html>' END AS raw
FROM events
""",
)
def response_parse(spark, sf_dir):
    """JSON bodies are parsed, others stay as strings; the status is kept beside."""
    bad = F.col("event_id") % 5 == 0
    responses = event_rows(spark, sf_dir).select(
        "event_id",
        F.when(bad, F.lit(502)).otherwise(F.lit(200)).alias("status"),
        F.when(bad, F.concat(F.lit("<html>"), "event_type", F.lit("</html>"))).otherwise(F.col("props")).alias("body"),
    )
    parsed = parse_responses(responses)
    kind = P.variant_kind(F.col("data"))
    return parsed.select(
        "event_id", "status", kind.alias("kind"),
        F.try_variant_get("data", "$.k", "bigint").alias("k"),
        F.when(kind == "STRING", F.try_variant_get("data", "$", "string")).alias("raw"),
    )


TOPIC_SCHEMA = {
    "type": "record",
    "name": "ActivityEvent",
    "fields": [
        {"name": "Kind", "type": "string"},
        {"name": "Owner", "type": ["null", "string"], "default": None},
        {"name": "Note", "type": "string", "default": "none"},
        {"name": "CreatedDate", "type": "long"},
    ],
}


@query(
    "publish_records",
    """
SELECT CAST(event_id AS VARCHAR) AS id, event_type || '!' AS kind, 'user ' || user_id AS owner, 'none' AS note,
       epoch_us(ts) // 1000 AS created
FROM events
""",
)
def records_for_topic(spark, sf_dir):
    events = event_envelope(spark, sf_dir)
    records = publish_records(
        events,
        {"Kind": "{{event.data.event_type}}!", "Owner": "user {{event.data.user_id}}", "CreatedDate": "overwritten"},
        TOPIC_SCHEMA,
        created_ms=F.floor(F.col("timestamp") / 1000),
    )
    good = records.where(F.col(ERROR).isNull())
    return good.select(
        "id", F.col("data.Kind").alias("kind"), F.col("data.Owner").alias("owner"),
        F.col("data.Note").alias("note"), F.col("data.CreatedDate").alias("created"),
    )
