"""Queries over projections, filters and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.subjects import path_subject, publish_subject, source_subject, subject_matches
from ..functions.template import render
from ..operators import script
from ..operators.convert import batch_to_json, to_json_value, to_record
from ..operators.envelope import ERROR, event_key, micros, to_events
from ..operators.errors import split_errors
from ..operators.iterate import iterate
from ..operators.tap import with_parsed_payload
from ..sources.tables import event_envelope, event_rows, table
from .registry import query

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query(
    "envelope",
    f"""
SELECT 'events.' || event_type AS subject, CAST(event_id AS VARCHAR) AS id,
       epoch_us(ts) AS "timestamp", 0 AS task_id, 'table_reader' AS task_type,
       user_id, value, {K} AS k
FROM events
""",
)
def envelope(spark, sf_dir):
    return event_envelope(spark, sf_dir).select(
        "subject", "id", "timestamp", "task_id", "task_type", "data.user_id", "data.value", "data.k"
    )


@query(
    "event_key",
    """
SELECT event_id, 'events.' || event_type || '.' ||
       CASE WHEN event_type = 'view' THEN CAST(epoch_us(ts) AS VARCHAR)
            ELSE CAST(event_id AS VARCHAR) END AS event_key
FROM events
""",
)
def key_of_event(spark, sf_dir):
    events = event_envelope(spark, sf_dir)
    some_without_id = events.withColumn(
        "id", F.when(F.col("data.event_type") != "view", F.col("id"))
    )
    return some_without_id.select("data.event_id", event_key().alias("event_key"))


@query(
    "template_render",
    f"""
SELECT event_id,
       'events/' || CAST({K} AS VARCHAR) || '/' || event_type || '/' AS path,
       'events.' || event_type || ' at ' || CAST(epoch_us(ts) AS VARCHAR) AS line,
       'no tags here' AS fixed
FROM events
""",
)
def template_render(spark, sf_dir):
    events = event_envelope(spark, sf_dir)
    return events.select(
        "data.event_id",
        render("events/{{event.data.k}}/{{ event.data.event_type }}/{{event.data.missing}}", events).alias("path"),
        render("{{event.subject}} at {{event.timestamp}}", events).alias("line"),
        render("no tags here", events).alias("fixed"),
    )


@query(
    "script_map",
    f"""
SELECT CAST(event_id AS VARCHAR) AS id, 'events.' || event_type AS subject,
       user_id, {K} * 2 AS doubled, {K} >= 50 AS large
FROM events
""",
)
def script_map(spark, sf_dir):
    mapped = script.script_map(
        event_envelope(spark, sf_dir),
        "named_struct('user_id', data.user_id, 'doubled', data.k * 2, 'large', data.k >= 50)",
    )
    return mapped.select("id", "subject", "data.*")


@query(
    "script_filter",
    """
SELECT event_id, event_type, value FROM events
WHERE value >= 10 AND event_type IN ('click', 'purchase')
""",
)
def script_filter(spark, sf_dir):
    kept = script.script_filter(
        event_envelope(spark, sf_dir),
        "data.value >= 10 AND data.event_type IN ('click', 'purchase')",
    )
    return kept.select("data.event_id", "data.event_type", "data.value")


@query(
    "script_fanout",
    f"""
SELECT event_id, unnest([x FOR x IN [{K}, {K} + 1, {K} + 2] IF x % 3 <> 0]) AS element
FROM events WHERE event_type <> 'error'
""",
)
def script_fanout(spark, sf_dir):
    spread = script.script_fanout(
        event_envelope(spark, sf_dir),
        "CASE WHEN data.event_type <> 'error' "
        "THEN filter(array(data.k, data.k + 1, data.k + 2), x -> x % 3 <> 0) END",
    )
    return spread.select(F.col("id").cast("bigint").alias("event_id"), F.col("data").alias("element"))


@query(
    "script_envelope",
    f"""
SELECT event_id,
       CASE WHEN {K} % 2 = 0 THEN 'even.' || event_type ELSE 'events.' || event_type END AS subject,
       CASE WHEN {K} % 3 = 0 THEN 'k' || CAST({K} AS VARCHAR) END AS id,
       value
FROM events
""",
)
def script_envelope(spark, sf_dir):
    edited = script.script_envelope(
        event_envelope(spark, sf_dir),
        "named_struct('subject', CASE WHEN data.k % 2 = 0 THEN concat('even.', data.event_type) END, "
        "'id', CASE WHEN data.k % 3 = 0 THEN concat('k', data.k) END, 'data', data)",
    )
    return edited.select("data.event_id", "subject", "id", "data.value")


@query(
    "subject_rewrite",
    """
WITH s AS (
  SELECT event_id, CASE event_id % 4
    WHEN 0 THEN 'pubsub.data.' || event_type
    WHEN 1 THEN 'pubsub.event.' || event_type || '.extra'
    WHEN 2 THEN 'pubsub.other.' || event_type
    ELSE event_type END AS old FROM events)
SELECT event_id, CASE event_id % 4
    WHEN 0 THEN 'data/' || split_part(old, '.', 3)
    WHEN 1 THEN 'event/' || split_part(old, '.', 3)
    ELSE old END AS subject
FROM s
""",
)
def subject_rewrite(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    turn = F.col("event_id") % 4
    subject = (
        F.when(turn == 0, F.concat(F.lit("pubsub.data."), "event_type"))
        .when(turn == 1, F.concat(F.lit("pubsub.event."), "event_type", F.lit(".extra")))
        .when(turn == 2, F.concat(F.lit("pubsub.other."), "event_type"))
        .otherwise(F.col("event_type"))
    )
    return rows.select("event_id", path_subject(subject).alias("subject"))


def _topics(spark, sf_dir):
    turn = F.col("event_id") % 3
    name = F.concat(F.initcap("event_type"), F.lit("ChangeEvent"))
    topic = (
        F.when(turn == 0, F.concat(F.lit("/data/"), name))
        .when(turn == 1, F.concat(F.lit("/event/"), name))
        .otherwise(F.concat(F.lit("Bare/"), name))
    )
    return event_rows(spark, sf_dir).select("event_id", topic.alias("topic"))


@query(
    "topic_subject",
    """
SELECT event_id, CASE event_id % 3 WHEN 2 THEN 'bare/' ELSE '' END || event_type || 'changeevent' AS subject
FROM events
""",
)
def topic_subject(spark, sf_dir):
    return _topics(spark, sf_dir).select("event_id", source_subject(F.col("topic")).alias("subject"))


@query(
    "publish_subject",
    """
SELECT event_id, CASE event_id % 3
    WHEN 0 THEN 'data.' || event_type || 'changeevent'
    WHEN 1 THEN 'event.' || event_type || 'changeevent'
    ELSE 'Bare/' || upper(event_type[1]) || event_type[2:] || 'ChangeEvent' END AS subject
FROM events
""",
)
def subject_for_publish(spark, sf_dir):
    return _topics(spark, sf_dir).select("event_id", publish_subject(F.col("topic")).alias("subject"))


@query(
    "subject_match",
    """
WITH s AS (SELECT event_id, 'shop.' || event_type || '.' || CAST(user_id % 3 AS VARCHAR) AS subject FROM events)
SELECT event_id,
       regexp_full_match(subject, 'shop\\..+') AS all_shop,
       regexp_full_match(subject, 'shop\\.[^.]+\\.1') AS second_shard,
       regexp_full_match(subject, 'shop\\.click\\..+') AS clicks,
       regexp_full_match(subject, '[^.]+\\.[^.]+') AS two_tokens,
       subject = 'shop.view.0' AS exact
FROM s
""",
)
def subject_match(spark, sf_dir):
    subject = F.concat(
        F.lit("shop."), F.col("event_type"), F.lit("."), (F.col("user_id") % 3).cast("string")
    )
    return event_rows(spark, sf_dir).select(
        "event_id",
        subject_matches(subject, "shop.>").alias("all_shop"),
        subject_matches(subject, "shop.*.1").alias("second_shard"),
        subject_matches(subject, "shop.click.>").alias("clicks"),
        subject_matches(subject, "*.*").alias("two_tokens"),
        subject_matches(subject, "shop.view.0").alias("exact"),
    )


@query(
    "normalize_keys",
    f"""
SELECT event_id, '{{"event_type":"' || event_type || '","legs":{{"toll-road":' || CAST({K} AS VARCHAR)
       || '}},"plain":1,"user_id":' || CAST(user_id AS VARCHAR) || '}}' AS payload
FROM events
""",
)
def normalize_keys(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    text = F.concat(
        F.lit('{"user_id":"replaced","plain":1,"user-id":'), F.col("user_id").cast("string"),
        F.lit(',"event-type":"'), F.col("event_type"),
        F.lit('","legs":{"toll-road":'), F.col("k").cast("string"), F.lit("}}"),
    )
    staged = rows.select("event_id", F.parse_json(text).alias("v"))
    return P.with_normalized_keys(staged, "n", "v").select("event_id", F.to_json("n").alias("payload"))


# A declared record with every schema feature: enum, unions, map, nested record, defaults.
TURN_SCHEMA = {
    "type": "record",
    "name": "TurnNote",
    "namespace": "dialogue",
    "fields": [
        {"name": "turn_key", "type": "long"},
        {"name": "speaker", "type": {"type": "enum", "name": "Speaker", "symbols": ["system", "user", "assistant"]}},
        {"name": "follows", "type": ["null", "dialogue.Speaker"], "default": None},
        {"name": "weight", "type": ["null", "long", "string"], "default": None},
        {"name": "marks", "type": {"type": "map", "values": "long"}, "default": {}},
        {"name": "channel", "type": "string", "default": "main"},
        {
            "name": "excerpt",
            "type": {
                "type": "record",
                "name": "Excerpt",
                "fields": [
                    {"name": "words", "type": "string"},
                    {"name": "places", "type": {"type": "array", "items": "int"}, "default": [0]},
                ],
            },
        },
    ],
}


@query(
    "to_record",
    """
SELECT conv_id, turn,
       CASE WHEN ok THEN role END AS speaker,
       CASE WHEN ok AND turn % 3 = 0 THEN turn END AS weight_number,
       CASE WHEN ok AND turn % 3 = 1 THEN 'w' || turn END AS weight_text,
       CASE WHEN ok THEN conv_id * 100 + turn END AS turn_key,
       CASE WHEN ok THEN 'main' END AS channel,
       CASE WHEN ok AND turn % 2 = 1 THEN turn END AS mark,
       CASE WHEN ok THEN text END AS words,
       CASE WHEN NOT ok THEN 'SchemaMismatch' END AS error
FROM (SELECT *, NOT (turn = 5 OR turn = 6 OR conv_id % 11 = 0) AS ok FROM conversations)
""",
)
def conform_to_record(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    turn = F.col("turn")
    members = F.to_json(
        F.struct(
            # A text where a number is declared.
            F.when(turn != 5, F.col("conv_id") * 100 + turn).alias("turn-key"),
            F.when(turn == 5, F.lit("five")).alias("turn_key"),
            F.col("role").alias("speaker"),
            F.when(turn % 3 == 0, turn).alias("weight"),
            F.when(turn % 2 == 1, F.create_map(F.lit("turn"), turn)).alias("marks"),
            # The required nested record is left out of some rows.
            F.when(turn != 6, F.struct(F.col("text").alias("words"))).alias("excerpt"),
            F.lit("not declared").alias("extra"),
        )
    )
    # The weight is a number, a text, or absent.
    worded = F.concat(F.expr("left(_members, length(_members) - 1)"), F.lit(',"weight":"w'), turn.cast("string"), F.lit('"}'))
    staged = rows.withColumn("_members", members)
    text = F.when(turn % 3 == 1, worded).otherwise(F.col("_members"))
    # Rows of every eleventh conversation are arrays instead of objects.
    text = F.when(F.col("conv_id") % 11 == 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    record = to_record(staged.select("conv_id", "turn", F.parse_json(text).alias("data")), TURN_SCHEMA)
    return record.select(
        "conv_id", "turn", "data.speaker", "data.turn_key", "data.channel",
        F.col("data.weight.long").alias("weight_number"),
        F.col("data.weight.string").alias("weight_text"),
        F.col("data.marks").getItem("turn").alias("mark"),
        F.col("data.excerpt.words").alias("words"),
        F.col(ERROR).alias("error"),
    )


READING_WRITTEN = {
    "type": "record",
    "name": "Reading",
    "fields": [
        {"name": "number", "type": "int"},
        {"name": "who", "type": ["null", "int"]},
        {"name": "what", "type": {"type": "enum", "name": "What", "symbols": ["click", "view", "error", "purchase", "signup"]}},
        {"name": "seen", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "k", "type": "int"},
        {"name": "weight", "type": "float"},
        {"name": "tags", "type": {"type": "array", "items": "int"}},
    ],
}
READING_READ = {
    "type": "record",
    "name": "Observation",
    "aliases": ["Reading"],
    "fields": [
        {"name": "id", "type": "long", "aliases": ["number"]},
        {"name": "user", "type": "long", "aliases": ["user_id", "who"]},
        {"name": "what", "type": {"type": "enum", "name": "What", "symbols": ["click", "view", "error", "signup"]}},
        {"name": "seen", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 4}},
        {"name": "k", "type": "float"},
        {"name": "weight", "type": "double"},
        {"name": "tags", "type": {"type": "array", "items": "double"}},
        {"name": "unit", "type": "string", "default": "each"},
        {"name": "day", "type": ["null", {"type": "int", "logicalType": "date"}], "default": None},
    ],
}


@query(
    "record_evolution",
    """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type = 'purchase' OR user_id % 50 = 0 AS misfit FROM events)
SELECT event_id, CASE WHEN misfit THEN 'SchemaMismatch' END AS error,
       CASE WHEN NOT misfit THEN event_id END AS id, CASE WHEN NOT misfit THEN user_id END AS "user",
       CASE WHEN NOT misfit THEN event_type END AS what, CASE WHEN NOT misfit THEN epoch_us(ts) END AS seen,
       CASE WHEN NOT misfit THEN k || '.2500' END AS price, CASE WHEN NOT misfit THEN CAST(k AS DOUBLE) END AS k,
       CASE WHEN NOT misfit THEN k + 0.5 END AS weight, CASE WHEN NOT misfit THEN 2.0 * k + 1 END AS tag_sum,
       CASE WHEN NOT misfit THEN 'each' END AS unit, CAST(NULL AS DATE) AS "day"
FROM e
""",
)
def record_evolution(spark, sf_dir):
    """Records of one schema read by a later one: promoted numbers, aliases, defaults,
    logical types; an enum symbol it lacks and a null it does not take are error rows."""
    rows = event_rows(spark, sf_dir)
    k = F.col("k")
    payload = F.struct(
        F.col("event_id").alias("number"),
        F.when(F.col("user_id") % 50 != 0, F.col("user_id")).alias("who"),
        F.col("event_type").alias("what"),
        micros(rows, "ts").alias("seen"),
        F.concat(k.cast("string"), F.lit(".25")).alias("price"),
        k.alias("k"),
        (k + 0.5).alias("weight"),
        F.array(k, k + 1).alias("tags"),
    )
    events = rows.select("event_id", F.parse_json(F.to_json(payload, {"ignoreNullFields": "false"})).alias("data"))
    read = to_record(events, READING_READ, writer=READING_WRITTEN)
    return read.select(
        "event_id", F.col(ERROR).alias("error"), "data.id", "data.user", "data.what", F.unix_micros("data.seen").alias("seen"),
        F.col("data.price").cast("string").alias("price"), F.col("data.k").cast("double").alias("k"), "data.weight",
        F.aggregate("data.tags", F.lit(0.0), lambda total, x: total + x).alias("tag_sum"), "data.unit", "data.day",
    )


@query(
    "record_to_json",
    f"""
SELECT event_id, event_type, {K} AS k, user_id,
       '{{"k":' || CAST({K} AS VARCHAR) || ',"none":null,"user_id":' || CAST(user_id AS VARCHAR) || '}}' AS payload
FROM events
""",
)
def record_to_json(spark, sf_dir):
    events = event_envelope(spark, sf_dir)
    as_json = to_json_value(events)
    fields = as_json.select(
        F.variant_get("data", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("data", "$.event_type", "string").alias("event_type"),
        F.variant_get("data", "$.k", "bigint").alias("k"),
        F.variant_get("data", "$.user_id", "bigint").alias("user_id"),
        F.struct(
            F.variant_get("data", "$.k", "bigint").alias("k"),
            F.lit(None).cast("string").alias("none"),
            F.variant_get("data", "$.user_id", "bigint").alias("user_id"),
        ).alias("_record"),
    )
    return fields.select(
        "event_id", "event_type", "k", "user_id",
        P.to_json_text(F.col("_record"), fields.schema["_record"].dataType).alias("payload"),
    )


@query(
    "batch_to_json",
    """
SELECT event_id // 100 AS batch_id, 0 AS chunk, count(*) AS n_rows,
       '[' || string_agg('{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}',
                         ',' ORDER BY event_id) || ']' AS data
FROM events GROUP BY 1
""",
)
def rows_as_batches(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    return batch_to_json(
        rows, F.floor(F.col("event_id") / 100), F.struct("event_id", "event_type"), order_by="event_id"
    )


def _json_events(spark, sf_dir, text):
    """Events whose payload is JSON text parsed once into VARIANT."""
    rows = event_rows(spark, sf_dir)
    return to_events(
        rows,
        data=F.parse_json(text),
        subject=F.concat(F.lit("events."), "event_type"),
        id=F.col("event_id"),
        timestamp=F.unix_micros(F.col("ts").cast("timestamp")),
        task_type="table_reader",
    )


def _pair_text(prefix: str = "", suffix: str = ""):
    """``[{"id":e,"n":k},{"id":e,"n":k+1}]`` between prefix and suffix."""
    e = F.col("event_id").cast("string")
    return F.concat(
        F.lit(prefix + '[{"id":'), e, F.lit(',"n":'), F.col("k").cast("string"),
        F.lit('},{"id":'), e, F.lit(',"n":'), (F.col("k") + 1).cast("string"), F.lit("}]" + suffix),
    )


@query(
    "batch_chunks",
    """
SELECT chunk, count(*) AS n_rows, min(event_id) AS first_event, max(event_id) AS last_event
FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS chunk FROM events)
GROUP BY chunk
""",
)
def one_batch_in_chunks(spark, sf_dir):
    """The whole table as one batch: chunks of 1,000 rows."""
    chunks = batch_to_json(event_rows(spark, sf_dir), F.lit("all"), F.struct("event_id"), order_by="event_id", chunk_rows=1000)
    elements = F.from_json("data", "array<struct<event_id:bigint>>")
    return chunks.select(
        "chunk", "n_rows",
        F.array_min(elements)["event_id"].alias("first_event"),
        F.array_max(elements)["event_id"].alias("last_event"),
    )


@query(
    "iterate_root",
    f"""
SELECT event_id AS element_id, {K} + step AS n, 'split' AS subject, CAST(NULL AS VARCHAR) AS id
FROM events, (VALUES (0), (1)) AS s(step)
""",
)
def iterate_root(spark, sf_dir):
    events = _json_events(spark, sf_dir, _pair_text())
    good, _ = split_errors(iterate(events, name="split"))
    return good.select(
        F.variant_get("data", "$.id", "bigint").alias("element_id"),
        F.variant_get("data", "$.n", "bigint").alias("n"),
        "subject", "id",
    )


@query(
    "iterate_key",
    f"""
SELECT event_id AS element_id, {K} + step AS n, 'items' AS subject
FROM events, (VALUES (0), (1)) AS s(step)
WHERE event_id % 7 NOT IN (1, 2)
""",
)
def iterate_key(spark, sf_dir):
    good, _ = split_errors(iterate(_broken_items(spark, sf_dir), "items", name="items"))
    return good.select(
        F.variant_get("data", "$.id", "bigint").alias("element_id"),
        F.variant_get("data", "$.n", "bigint").alias("n"),
        "subject",
    )


def _broken_items(spark, sf_dir):
    """Payloads with ``items``; some lack the key, some hold an object, some are not JSON."""
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 1, F.lit('{"other":[1,2,3]}'))
        .when(kind == 2, F.lit('{"items":{"not":"an array"}}'))
        .otherwise(_pair_text('{"total":2,"items":', "}"))
    )
    return _json_events(spark, sf_dir, text)


@query(
    "error_rows",
    """
SELECT event_id, 'events.' || event_type AS subject,
       CASE event_id % 7 WHEN 1 THEN 'KeyNotFound' WHEN 2 THEN 'ExpectedArray' END AS error
FROM events WHERE event_id % 7 IN (1, 2)
""",
)
def error_rows(spark, sf_dir):
    _, failed = split_errors(iterate(_broken_items(spark, sf_dir), "items", name="items"))
    return failed.select(
        F.col("id").cast("bigint").alias("event_id"), "subject", F.col(ERROR).alias("error")
    )


@query(
    "error_classes",
    f"""
SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'InvalidJson' WHEN 2 THEN 'SchemaMismatch' WHEN 3 THEN 'KeyNotFound' ELSE 'ExpectedArray' END AS error
FROM events WHERE event_id % 5 > 0
""",
)
def error_classes(spark, sf_dir):
    """Rows fail in different steps of one chain; each keeps the first class it met."""
    rows = event_rows(spark, sf_dir)
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 1, F.lit("{broken"))
        .when(kind == 2, F.lit('{"items":"none","k":"text"}'))
        .when(kind == 3, F.concat(F.lit('{"k":'), F.col("k").cast("string"), F.lit("}")))
        .when(kind == 4, F.concat(F.lit('{"items":5,"k":'), F.col("k").cast("string"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"items":[1],"k":'), F.col("k").cast("string"), F.lit("}")))
    )
    events = to_events(
        rows, data=text, subject="in", id=F.col("event_id"), timestamp=F.col("event_id"), task_type="table_reader"
    )
    schema = {"type": "record", "name": "Row", "fields": [{"name": "k", "type": "long"}]}
    checked = to_record(events, schema)
    # The record is what conforms; the element list is read from the text that came in.
    again = checked.join(events.select(F.col("id").alias("_id"), F.parse_json(F.when(kind_of("id") != 1, F.col("data"))).alias("_data")), F.col("id") == F.col("_id"))
    spread = iterate(again.withColumn("data", F.col("_data")).drop("_id", "_data"), "items", name="items")
    _, failed = split_errors(spread)
    return failed.select(F.col("id").cast("bigint").alias("event_id"), F.col(ERROR).alias("error"))


def kind_of(column: str):
    return F.col(column).cast("bigint") % 5


@query(
    "script_envelope_json",
    f"""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'events.' || event_type ELSE 'moved' END AS subject,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS id, {K} AS k
FROM events
""",
)
def envelope_of_json(spark, sf_dir):
    """A JSON result with subject and data edits the envelope, any other is the payload."""
    events = _json_events(spark, sf_dir, F.to_json(F.struct("event_id", "k")))
    moved = "concat('{\"subject\":\"moved\",\"data\":', to_json(data), '}')"
    out = script.script_envelope(events, f"parse_json(if(cast(id as bigint) % 2 = 0, to_json(data), {moved}))")
    return out.select(
        F.variant_get("data", "$.event_id", "bigint").alias("event_id"), "subject", "id",
        F.variant_get("data", "$.k", "bigint").alias("k"),
    )


@query(
    "tap_parsed",
    f"""
SELECT event_id,
       CASE event_id % 3 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'OBJECT' ELSE 'STRING' END AS kind,
       CASE WHEN event_id % 3 < 2 THEN {K} END AS k
FROM events
""",
)
def tap_parsed(spark, sf_dir):
    turn = F.col("event_id") % 3
    text = (
        F.when(turn == 0, F.col("props"))
        .when(turn == 1, F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"')))
        .otherwise(F.concat(F.lit('"plain '), "event_type", F.lit('"')))
    )
    events = _json_events(spark, sf_dir, text)
    seen = with_parsed_payload(events, "seen")
    return seen.select(
        F.col("id").cast("bigint").alias("event_id"),
        P.variant_kind(F.col("seen")).alias("kind"),
        F.try_variant_get("seen", "$.k", "bigint").alias("k"),
    )
