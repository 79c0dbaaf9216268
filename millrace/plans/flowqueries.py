"""Whole flows, declared as config and run as chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.auth import Credentials
from ..functions.template import render
from ..operators.envelope import ERROR, to_events
from ..operators.script import script_filter
from ..session import scratch_path
from ..sinks.files import with_event_date
from ..sources.files import read_json_lines
from ..sources.tables import event_envelope, table
from .flow import Bindings, parse_flow, run_flow
from .registry import query


def land_counts(spark, sf_dir):
    """Envelope → filter → destination → date layout, counted; one lazy plan."""
    kept = script_filter(event_envelope(spark, sf_dir), "data.value >= 10")
    placed = with_event_date(kept.withColumn("destination", render("landing/{{event.subject}}", kept)))
    return placed.groupBy("destination", "year", "month", "day").agg(F.count(F.lit(1)).alias("n_events"))


_LAND_SPEC = {
    "flow": {
        "name": "land_events",
        "labels": {"team": "data"},
        "tasks": [
            {"nats_jetstream_subscriber": {"name": "start", "subject": "events.>"}},
            {"script": {"name": "large_only", "mode": "filter", "code": "data.value >= 10"}},
            {
                "script": {
                    "name": "path_subject",
                    "mode": "envelope",
                    "code": "named_struct('subject', concat('events/', data.event_type), 'id', id, 'data', data)",
                }
            },
            {
                "object_store_writer": {
                    "name": "land",
                    "path": "file:///landing/{{event.subject}}",
                    "hive_partition_options": {"enabled": True, "partition_keys": ["EventDate"]},
                }
            },
        ],
    }
}


@query(
    "flow_land_events",
    """
SELECT 'events/' || event_type AS destination, day(ts) AS "day", count(*) AS rows, max(event_id) AS last_event
FROM events WHERE value >= 10 GROUP BY 1, 2
""",
)
def flow_land_events(spark, sf_dir):
    """Subscribe → filter → rewrite subject → land by destination and date."""
    root = scratch_path(spark, "flow")
    bindings = Bindings(inputs={"start": event_envelope(spark, sf_dir)}, root=root)
    result = run_flow(spark, parse_flow(_LAND_SPEC), bindings)
    payload = "event_id bigint, user_id bigint, event_type string, value double, k bigint"
    landed = read_json_lines(spark, result.written["land"], payload).select("data.*", "destination", "day")
    return landed.groupBy("destination", F.col("day").cast("bigint").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("last_event")
    )


def order_documents(spark, sf_dir):
    """One document per order with an array of its lines.

    Lines are gathered in chunks of at most 100 line numbers, so a document is
    bounded even if one order held most of the table.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.floor(F.col("l_linenumber") / 100).alias("chunk"),
        F.struct(
            "l_orderkey",
            F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
            "l_partkey",
            "l_quantity",
        ).alias("line"),
    )
    gathered = lines.groupBy("l_orderkey", "chunk").agg(F.collect_list("line").alias("lines"))
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(gathered, orders.o_orderkey == gathered.l_orderkey)
    return to_events(
        joined,
        data=F.struct("o_orderkey", "o_custkey", "lines"),
        subject="orders",
        id=F.col("o_orderkey"),
        timestamp=F.unix_micros(F.col("o_orderdate").cast("timestamp")),
        task_type="table_reader",
    )


_FANOUT_SPEC = {
    "flow": {
        "name": "orders_fanout",
        "tasks": [
            {"nats_jetstream_subscriber": {"name": "orders", "subject": "orders"}},
            {"iterate": {"name": "lines", "iterate_key": "lines"}},
            {
                "script": {
                    "name": "shape",
                    "mode": "map",
                    "code": "named_struct('order', data.l_orderkey, 'line', data.l_linenumber, "
                    "'part', data.l_partkey, 'large', data.l_quantity >= 25)",
                }
            },
        ],
    }
}


@query(
    "flow_orders_fanout",
    """
SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part,
       l_quantity >= 25 AS large, 'lines' AS subject, 2 AS task_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""",
)
def flow_orders_fanout(spark, sf_dir):
    """Orders with an array of lines → one event per line → projection."""
    bindings = Bindings(inputs={"orders": order_documents(spark, sf_dir)})
    result = run_flow(spark, parse_flow(_FANOUT_SPEC), bindings)
    return result.outputs[0].select("data.*", "subject", "task_id")


_CSV_SPEC = {
    "flow": {
        "name": "csv_rows",
        "tasks": [
            {"generate": {"name": "tick", "interval": "1h", "count": 1}},
            {"object_store_reader": {"name": "read", "path": "file:///inbox", "format": "csv"}},
            {"convert": {"name": "to_json", "target_format": "json"}},
            {"iterate": {"name": "rows"}},
            {"script": {"name": "purchases", "mode": "filter", "code": "data.event_type = 'purchase'"}},
            {"object_store_writer": {"name": "land", "path": "file:///outbox", "format": "csv"}},
        ],
    }
}


@query(
    "flow_csv_rows",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'",
)
def flow_csv_rows(spark, sf_dir):
    """Tick → read CSV batches → JSON array → iterate → filter → land.

    The batch → array → element steps cancel out; rows stay typed columns and the
    filter is pushed to the CSV scan.
    """
    root = scratch_path(spark, "flow")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").write.option("header", True).csv(
        f"{root}/inbox"
    )
    result = run_flow(spark, parse_flow(_CSV_SPEC), Bindings(root=root))
    landed = spark.read.schema("event_id bigint, user_id bigint, event_type string").option("header", True)
    return landed.csv(result.written["land"]).drop("run")


_INTAKE_SPEC = {
    "flow": {
        "name": "order_intake",
        "tasks": [
            {"http_webhook": {"name": "till", "method": "PUT", "endpoint": "/orders", "headers": {"x-desk": ""}}},
            {
                "script": {
                    "name": "priced",
                    "mode": "envelope",
                    "code": "named_struct('subject', try_variant_get(data.payload, '$.status', 'string'), "
                    "'id', try_variant_get(data.payload, '$.order', 'string'), 'data', data.payload)",
                }
            },
            {
                "nats_jetstream_publisher": {
                    "name": "ledger",
                    "subject": "orders.{{event.subject}}",
                    "stream": {"name": "ledger", "max_messages_per_subject": 1500, "discard": "old"},
                }
            },
        ],
    }
}

_ARCHIVE_SPEC = {
    "flow": {
        "name": "order_archive",
        "tasks": [
            {"nats_jetstream_subscriber": {"name": "settled", "subject": "orders.F", "durable_name": "archive"}},
            {
                "convert": {
                    "name": "typed",
                    "target_format": "avro",
                    "schema": {
                        "type": "record",
                        "name": "SettledOrder",
                        "fields": [
                            {"name": "order", "type": "long"},
                            {"name": "total", "type": ["null", "double"], "default": None},
                            {"name": "desk", "type": "string", "default": "none"},
                        ],
                    },
                }
            },
            {"object_store_writer": {"name": "shelf", "path": "file:///{{event.subject}}/orders"}},
        ],
    }
}


@query(
    "flow_messages",
    """
SELECT o_orderkey AS "order", o_totalprice AS total, 'none' AS desk, 'typed/orders' AS destination
FROM orders
WHERE o_orderstatus = 'F' AND o_custkey % 5 <> 0 AND o_orderkey > 500
  AND o_orderkey IN (SELECT o_orderkey FROM (
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) AS place
    FROM orders WHERE o_custkey % 5 <> 0) WHERE place <= 1500)
""",
)
def flow_messages(spark, sf_dir):
    """Two flows over one stream: requests → ledger, ledger → typed files.

    Requests of every fifth customer have no credentials and are turned away.  The
    ledger keeps 1,500 messages per subject, and the archive goes on after its cursor.
    """
    root = scratch_path(spark, "flow")
    orders = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_custkey") % 5 != 0, F.lit("Bearer desk-7")).otherwise(F.lit("none"))
    requests = orders.select(
        F.create_map(F.lit("Authorization"), key, F.lit("X-Desk"), F.lit("7"), F.lit("x-desk "), F.lit("-")).alias("headers"),
        F.to_json(
            F.struct(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
        ).alias("body"),
        F.col("o_orderkey").alias("timestamp"),
    )
    intake = Bindings(
        inputs={"till": requests}, credentials={"till": Credentials(bearer="desk-7")}, message_tables={"ledger": f"{root}/ledger"}, root=root
    )
    ledger = run_flow(spark, parse_flow(_INTAKE_SPEC), intake).streams["ledger"]
    # The cursor stands at the message of order 500.
    last = spark.read.parquet(f"{root}/ledger").where(F.col("timestamp") <= 500)
    cursors = last.agg(F.coalesce(F.max("sequence"), F.lit(0)).alias("replay_id")).select(F.lit("archive").alias("name"), "replay_id")
    archive = Bindings(inputs={"settled": ledger}, cursors=cursors, root=f"{root}/files")
    result = run_flow(spark, parse_flow(_ARCHIVE_SPEC), archive)
    shelf = spark.read.option("basePath", result.written["shelf"]).parquet(result.written["shelf"])
    return shelf.select("order", "total", "desk", "destination")


_RECORD_SPEC = {
    "flow": {
        "name": "events_to_records",
        "tasks": [
            {"nats_jetstream_subscriber": {"name": "start", "subject": "events.>"}},
            {
                "script": {
                    "name": "shape",
                    "mode": "map",
                    "code": "named_struct('event', data.event_id, 'kind', data.event_type, "
                    "'amount', if(data.event_id % 9 = 0, 'unknown', cast(data.k as string)))",
                }
            },
            {
                "script": {
                    "name": "numbers",
                    "mode": "map",
                    "code": "parse_json(concat('{\"event\":', data.event, ',\"kind\":\"', data.kind, '\",\"amount\":', "
                    "if(data.amount = 'unknown', '\"unknown\"', data.amount), '}'))",
                }
            },
            {
                "convert": {
                    "name": "typed",
                    "target_format": "avro",
                    "schema": {
                        "type": "record",
                        "name": "Amount",
                        "fields": [
                            {"name": "event", "type": "long"},
                            {"name": "amount", "type": "long"},
                            {"name": "unit", "type": "string", "default": "piece"},
                        ],
                    },
                }
            },
            {"object_store_writer": {"name": "land", "path": "file:///amounts"}},
        ],
    }
}

_RECORD_SQL = """
SELECT event_id AS event, CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS amount,
       CASE WHEN event_id % 9 <> 0 THEN 'piece' END AS unit, CASE WHEN event_id % 9 = 0 THEN 'SchemaMismatch' END AS error
FROM events
"""


@query("flow_script_to_record", _RECORD_SQL)
def flow_script_to_record(spark, sf_dir):
    """Typed columns a script made are conformed; what does not fit is set aside."""
    root = scratch_path(spark, "flow")
    result = run_flow(spark, parse_flow(_RECORD_SPEC), Bindings(inputs={"start": event_envelope(spark, sf_dir)}, root=root))
    landed = spark.read.parquet(result.written["land"]).select("event", "amount", "unit", F.lit(None).cast("string").alias("error"))
    failed = result.errors["typed"].select(
        F.col("id").cast("bigint").alias("event"), F.lit(None).cast("bigint").alias("amount"),
        F.lit(None).cast("string").alias("unit"), F.col(ERROR).alias("error"),
    )
    return landed.unionByName(failed)


@query("stream_flow_errors", _RECORD_SQL)
def stream_flow_errors(spark, sf_dir):
    """The same flow on a stream of several batches: good and bad rows are landed."""
    root = scratch_path(spark, "flow")
    envelope = event_envelope(spark, sf_dir)
    envelope.repartition(4, F.col("id")).write.parquet(f"{root}/inbox")
    stream = spark.readStream.schema(envelope.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/inbox")
    bindings = Bindings(inputs={"start": stream}, root=root, checkpoints=f"{root}/checkpoints")
    result = run_flow(spark, parse_flow(_RECORD_SPEC), bindings)
    for running in result.queries.values():
        running.awaitTermination()
    landed = spark.read.parquet(result.written["land"]).select("event", "amount", "unit", F.lit(None).cast("string").alias("error"))
    failed = spark.read.parquet(result.error_tables["typed"]).select(
        F.col("id").cast("bigint").alias("event"), F.lit(None).cast("bigint").alias("amount"),
        F.lit(None).cast("string").alias("unit"), F.col(ERROR).alias("error"),
    )
    return landed.unionByName(failed)
