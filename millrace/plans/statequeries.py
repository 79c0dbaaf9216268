"""Queries over state, replay, deduplication, retention and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retention
from ..operators.dedup import dedup
from ..operators.envelope import micros
from ..operators.state import last_run_key, state_history, state_latest
from ..session import scratch_path
from ..sinks.publish import append_messages, publish, publish_batch, read_messages
from ..sources.messages import replay_from, subscribe, subscribe_many
from ..sources.tables import event_envelope, event_rows
from .registry import query


def state_log(spark, sf_dir):
    """Append log: key = user, value = event type, revision = event id."""
    return event_rows(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.col("event_type").alias("value"), F.col("event_id").alias("revision")
    )


def message_log(spark, sf_dir):
    """Stored messages: sequence, subject, timestamp and size."""
    rows = event_rows(spark, sf_dir)
    return rows.select(
        F.col("event_id").alias("sequence"),
        F.concat(F.lit("events."), "event_type").alias("subject"),
        micros(rows, "ts").alias("timestamp"),
        F.length("props").cast("bigint").alias("bytes"),
    )


@query(
    "state_latest",
    'SELECT user_id AS "key", arg_max(event_type, event_id) AS value, max(event_id) AS revision FROM events GROUP BY 1',
)
def latest(spark, sf_dir):
    return state_latest(state_log(spark, sf_dir))


@query(
    "state_history",
    """
SELECT user_id AS "key", event_type AS value, event_id AS revision,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS position
FROM events QUALIFY position <= 10
""",
)
def history(spark, sf_dir):
    return state_history(state_log(spark, sf_dir)).withColumn("position", F.col("position").cast("bigint"))


@query(
    "last_run_state",
    """
SELECT 'nightly.generate.' || event_type || '.last_run' AS "key",
       max(epoch_us(ts)) // 1000000 AS value
FROM events GROUP BY 1
""",
)
def last_run_state(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    log = rows.select(
        last_run_key("nightly", "generate", F.col("event_type")).alias("key"),
        F.floor(micros(rows, "ts") / 1_000_000).alias("value"),
        micros(rows, "ts").alias("revision"),
    )
    return state_latest(log).select("key", "value")


@query(
    "subscribe_landed",
    "SELECT event_id AS sequence, 'events.' || event_type AS subject FROM events WHERE event_type = 'click'",
)
def subscribe_landed(spark, sf_dir):
    """A subscription over a stored message table: its subject test reaches the scan."""
    place = scratch_path(spark, "messages")
    append_messages(message_log(spark, sf_dir).withColumn("duplicate", F.lit(False)), place)
    return subscribe(spark.read.parquet(place), "events.click").select("sequence", "subject")


@query(
    "replay_after_cursor",
    """
SELECT event_id AS sequence, 'events.' || event_type AS subject FROM events
WHERE event_id > (SELECT max(event_id) * 3 // 5 FROM events)
""",
)
def replay_after_cursor(spark, sf_dir):
    messages = message_log(spark, sf_dir)
    cursors = messages.agg((F.floor(F.max("sequence") * 3 / 5)).alias("replay_id")).select(
        F.lit("orders-reader").alias("name"), "replay_id"
    )
    return replay_from(messages, cursors, "orders-reader").select("sequence", "subject")


@query(
    "subscribe_filter",
    """
SELECT event_id AS sequence, 'events.' || event_type AS subject FROM events
WHERE event_type = 'purchase'
""",
)
def subscribe_filter(spark, sf_dir):
    shaped = event_envelope(spark, sf_dir).select(
        F.col("id").cast("bigint").alias("sequence"), "subject"
    )
    return subscribe(shaped, "events.purchase")


# Rows of an id in time order, each against the last accepted one.
DEDUP_SQL = """
WITH RECURSIVE m AS (
  SELECT user_id, event_type, event_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
  FROM events),
walk AS (
  SELECT user_id, event_type, n, event_id, t AS kept, true AS accepted FROM m WHERE n = 1
  UNION ALL
  SELECT m.user_id, m.event_type, m.n, m.event_id,
         CASE WHEN m.t >= w.kept + 259200000000 THEN m.t ELSE w.kept END,
         m.t >= w.kept + 259200000000
  FROM walk w JOIN m ON m.user_id = w.user_id AND m.event_type = w.event_type AND m.n = w.n + 1)
SELECT event_id, user_id, event_type FROM walk WHERE accepted
"""


@query("dedup_window", DEDUP_SQL)
def dedup_window(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    messages = rows.select(
        "event_id", "user_id", "event_type",
        F.concat_ws(".", "user_id", "event_type").alias("id"),
        micros(rows, "ts").alias("timestamp"),
    )
    return dedup(messages, "id", "timestamp", "event_id", "3d").select("event_id", "user_id", "event_type")


@query(
    "dedup_hot_id",
    """
WITH RECURSIVE m AS (
  SELECT CASE WHEN event_id % 10 < 9 THEN 'hot' ELSE event_type END AS id, epoch_us(ts) AS t, min(event_id) AS event_id FROM events GROUP BY 1, 2),
walk AS (
  SELECT id, min(t) AS t FROM m GROUP BY id
  UNION ALL
  SELECT id, t FROM (
    SELECT m.id, m.t, row_number() OVER (PARTITION BY m.id ORDER BY m.t) AS n FROM walk w JOIN m ON m.id = w.id AND m.t >= w.t + 21600000000) WHERE n = 1)
SELECT id, m.event_id FROM walk JOIN m USING (id, t)
""",
)
def dedup_hot_id(spark, sf_dir):
    """A six-hour window; nine rows of ten share one id."""
    rows = event_rows(spark, sf_dir)
    hot = F.when(F.col("event_id") % 10 < 9, F.lit("hot")).otherwise(F.col("event_type"))
    return dedup(rows.select("event_id", hot.alias("id"), micros(rows, "ts").alias("timestamp")), "id", "timestamp", "event_id", "6h").select("id", "event_id")


_SHOP = "'shop.' || event_type || '.' || (user_id % 5)"


@query(
    "subscribe_many",
    f"""
SELECT durable_name, event_id AS sequence FROM events JOIN (VALUES
  ('everything', '.+'), ('clicks', 'shop[.]click[.].+'), ('one', 'shop[.]view[.]3'), ('threes', 'shop[.][^.]+[.]3'),
  ('shop', 'shop[.].+'), ('types', 'shop[.][^.]+'), ('any', '[^.]+[.]purchase[.][^.]+'), ('again', 'shop[.]view[.]3')
) AS p(durable_name, pattern) ON regexp_full_match({_SHOP}, pattern)
""",
)
def subscriptions(spark, sf_dir):
    """Eight overlapping subscriptions, the messages read once."""
    messages = event_rows(spark, sf_dir).select(F.col("event_id").alias("sequence"), F.expr(_SHOP).alias("subject"))
    patterns = {
        "everything": ">", "clicks": "shop.click.>", "one": "shop.view.3", "threes": "shop.*.3",
        "shop": "shop.>", "types": "shop.*", "any": "*.purchase.*", "again": "shop.view.3",
    }
    return subscribe_many(messages, patterns).select("durable_name", "sequence")


@query(
    "retain_age",
    """
SELECT event_id AS sequence FROM events
WHERE epoch_us(ts) >= (SELECT max(epoch_us(ts)) FROM events) - 604800 * 1000000::BIGINT
""",
)
def retain_age(spark, sf_dir):
    messages = message_log(spark, sf_dir)
    now = messages.agg(F.max("timestamp")).scalar()
    return retention.retain_age(messages, 604_800, now=now).select("sequence")


@query(
    "retain_per_subject",
    """
SELECT event_id AS sequence, 'events.' || event_type AS subject FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 100
""",
)
def retain_per_subject(spark, sf_dir):
    return retention.retain_per_subject(message_log(spark, sf_dir), 100).select("sequence", "subject")


@query(
    "retain_hot_subject",
    """
SELECT event_id AS sequence, subject FROM (
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'events.' || event_type ELSE 'hot' END AS subject FROM events)
QUALIFY row_number() OVER (PARTITION BY subject ORDER BY event_id) <= 150
""",
)
def retain_hot_subject(spark, sf_dir):
    """The oldest messages of every subject; one subject has nine of ten."""
    subject = F.when(F.col("sequence") % 10 == 0, F.col("subject")).otherwise(F.lit("hot"))
    messages = message_log(spark, sf_dir).withColumn("subject", subject)
    return retention.retain_per_subject(messages, 150, discard="new").select("sequence", "subject")


@query(
    "retain_null_subject",
    """
SELECT event_id AS sequence, subject FROM (
  SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view') THEN 'events.' || event_type END AS subject FROM events)
QUALIFY row_number() OVER (PARTITION BY subject ORDER BY event_id DESC) <= 1200
""",
)
def retain_null_subject(spark, sf_dir):
    """Messages without a subject are held to the limit like a subject of their own."""
    messages = message_log(spark, sf_dir)
    none = F.col("subject").isin("events.click", "events.view")
    messages = messages.withColumn("subject", F.when(~none, F.col("subject")))
    return retention.retain_per_subject(messages, 1200).select("sequence", "subject")


@query(
    "retain_total",
    """
SELECT event_id AS sequence FROM events
QUALIFY row_number() OVER (ORDER BY event_id DESC) <= (SELECT count(*) // 2 FROM events)
""",
)
def retain_total(spark, sf_dir):
    messages = message_log(spark, sf_dir)
    half = messages.count() // 2
    return retention.retain_total(messages, half).select("sequence")


@query(
    "retain_bytes",
    """
SELECT sequence, bytes FROM (
  SELECT event_id AS sequence, length(props) AS bytes,
         sum(length(props)) OVER (ORDER BY event_id DESC) AS running,
         sum(length(props)) OVER () AS total
  FROM events) WHERE running <= total // 3
""",
)
def retain_bytes(spark, sf_dir):
    messages = message_log(spark, sf_dir)
    third = messages.agg(F.sum("bytes").alias("b")).first()["b"] // 3
    return retention.retain_bytes(messages, third).select("sequence", "bytes")


@query(
    "publish_ack",
    """
SELECT CAST(event_id AS VARCHAR) AS id, 'shop.' || event_type AS subject, 'shop' AS stream,
       row_number() OVER (ORDER BY ts, event_id) AS sequence,
       CAST(NULL AS VARCHAR) AS domain, false AS duplicate
FROM events
""",
)
def publish_ack(spark, sf_dir):
    messages = publish(event_envelope(spark, sf_dir), "shop", "shop.{{event.data.event_type}}")
    return messages.select("id", "subject", "stream", "sequence", "domain", "duplicate")


@query(
    "publish_replayed",
    """
SELECT event_id, row_number() OVER (ORDER BY event_id % 3, ts, event_id) AS sequence FROM events
""",
)
def publish_replayed(spark, sf_dir):
    """Three batches into one message table, two of them sent again: numbered once."""
    path = scratch_path(spark, "replayed")
    events = event_envelope(spark, sf_dir).withColumn("number", F.col("data.event_id"))
    for batch in (0, 1, 1, 2, 0):
        part = events.where(F.col("number") % 3 == batch)
        publish_batch(part, path, "shop", "shop.{{event.data.event_type}}", batch=str(batch), order_by=["timestamp", "number"])
    return read_messages(spark, path).select(F.col("number").alias("event_id"), "sequence")


@query(
    "publish_duplicates",
    """
WITH RECURSIVE m AS (
  SELECT user_id, event_type, event_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
  FROM events),
walk AS (
  SELECT user_id, event_type, n, event_id, t AS kept, event_id AS original FROM m WHERE n = 1
  UNION ALL
  SELECT m.user_id, m.event_type, m.n, m.event_id,
         CASE WHEN m.t >= w.kept + 86400000000 THEN m.t ELSE w.kept END,
         CASE WHEN m.t >= w.kept + 86400000000 THEN m.event_id ELSE w.original END
  FROM walk w JOIN m ON m.user_id = w.user_id AND m.event_type = w.event_type AND m.n = w.n + 1),
numbered AS (
  SELECT event_id AS original, row_number() OVER (ORDER BY ts, event_id) AS sequence
  FROM events WHERE event_id IN (SELECT original FROM walk))
SELECT event_id, sequence, event_id <> original AS duplicate FROM walk JOIN numbered USING (original)
""",
)
def publish_duplicates(spark, sf_dir):
    """Acks under a one-day duplicate window, message id = user and event type."""
    events = event_envelope(spark, sf_dir)
    named = events.withColumns(
        {"id": F.concat_ws(".", "data.user_id", "data.event_type"), "number": F.col("data.event_id")}
    )
    out = publish(
        named, "shop", "shop.{{event.data.event_type}}",
        order_by=["timestamp", "number"], tie=F.col("number"), duplicate_window="1day",
    )
    return out.select(F.col("number").alias("event_id"), "sequence", "duplicate")
