"""Flows: an ordered task list run as a chain of DataFrame steps.

A task reads what the task before it emitted.  A source never receives, so it
starts a new segment of its own; a first task that is not a source never runs.
Each segment is one DataFrame, folded step by step, and Catalyst plans it whole.
"""

from __future__ import annotations

import glob
import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.auth import Credentials
from ..functions.payload import to_json_text
from ..functions.subjects import publish_subject, source_subject
from ..operators import convert, errors, requests, script
from ..operators.envelope import COLUMNS, restamp
from ..operators.iterate import iterate
from ..operators.retention import Limits, retain
from ..operators.tap import tap
from ..sinks import export, files as file_sink
from ..sinks.publish import publish, publish_batch
from ..sources import files as file_source
from ..sources.messages import advance_cursor, commit_cursor, replay_from, stored_cursor, subscribe
from ..sources.requests import ingest_requests
from ..sources.schedule import check_schedule, cron_schedule, interval_schedule, run_windows
from ..streaming.streams import bind_filter, for_each_batch

log = logging.getLogger(__name__)

# Task types, and those that are sources.
TASK_TYPES = (
    "convert",
    "iterate",
    "log",
    "script",
    "object_store_reader",
    "object_store_writer",
    "generate",
    "http_request",
    "http_webhook",
    "nats_jetstream_subscriber",
    "nats_jetstream_publisher",
    "salesforce_pubsub_subscriber",
    "salesforce_pubsub_publisher",
    "salesforce_bulkapi_job_creator",
)
SOURCE_TYPES = (
    "generate",
    "http_webhook",
    "nats_jetstream_subscriber",
    "salesforce_pubsub_subscriber",
)


# Tasks that write.
SINK_TYPES = (
    "object_store_writer",
    "nats_jetstream_publisher",
    "salesforce_bulkapi_job_creator",
)


# Tasks that may set rows aside.
MARKING_TYPES = ("convert", "iterate", "object_store_reader", "http_request", "salesforce_pubsub_publisher")


@dataclass(frozen=True)
class Task:
    task_id: int
    type: str
    name: str
    config: dict[str, Any]

    @property
    def is_source(self) -> bool:
        return self.type in SOURCE_TYPES


@dataclass(frozen=True)
class Flow:
    name: str
    tasks: tuple[Task, ...]
    labels: dict[str, Any] = field(default_factory=dict)

    def segments(self) -> list[list[Task]]:
        """Runs of tasks that hand events to each other, each led by a source."""
        found: list[list[Task]] = []
        for task in self.tasks:
            if task.is_source:
                found.append([task])
            elif found:
                found[-1].append(task)
        return found


@dataclass
class Bindings:
    """What a flow needs from outside: tables for its sources, places for its sinks."""

    inputs: dict[str, DataFrame] = field(default_factory=dict)
    """Events (or request log, or messages) per source task name."""
    responses: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    """Per request task: requests → the same rows with ``body`` and ``status``."""
    message_tables: dict[str, str] = field(default_factory=dict)
    """Per stream name: path of the message table."""
    root: str = ""
    """Prefix for file paths, in front of the path part of each configured URL."""
    start: int = 0
    """Epoch second at which schedules begin."""
    end: int | None = None
    checkpoints: str = ""
    """Folder for stream checkpoints; needed when an input is a stream."""
    once: bool = True
    """Drain a stream and stop, or keep it running."""
    credentials: dict[str, Credentials] = field(default_factory=dict)
    """What callers of a webhook task must present, by task name."""
    cursors: DataFrame | None = None
    """Stored cursors (``name, replay_id``) of durable subscriptions."""
    cursor_store: str = ""
    """Folder of durable names: their filters, and the cursors that streams commit."""


@dataclass
class Result:
    outputs: list[DataFrame] = field(default_factory=list)
    """Events emitted by the last task of each segment."""
    errors: dict[str, DataFrame] = field(default_factory=dict)
    """Rows a task could not process, by task name."""
    written: dict[str, str] = field(default_factory=dict)
    """Paths written, by task name."""
    observations: dict[str, Any] = field(default_factory=dict)
    queries: dict[str, Any] = field(default_factory=dict)
    """Streaming queries started, by the name of the first task they run per batch."""
    cursors: dict[str, DataFrame] = field(default_factory=dict)
    """Cursor row after this run's messages, by the durable name."""
    streams: dict[str, DataFrame] = field(default_factory=dict)
    """Messages a stream holds under its declared limits, by stream name."""
    error_tables: dict[str, str] = field(default_factory=dict)
    """Folder of the error rows of a streaming task, one subfolder per batch."""


def parse_flow(spec: dict[str, Any]) -> Flow:
    """Config dict → flow.  Unknown fields are tolerated, unknown task types are not."""
    body = spec["flow"]
    tasks = []
    for position, entry in enumerate(body["tasks"]):
        if len(entry) != 1:
            raise ValueError(f"task {position} names {len(entry)} types")
        kind, config = next(iter(entry.items()))
        if kind not in TASK_TYPES:
            raise ValueError(f"unknown task type {kind!r}")
        if "name" not in config:
            raise ValueError(f"task {position} has no name")
        tasks.append(Task(position, kind, config["name"], dict(config)))
    return Flow(body["name"], tuple(tasks), dict(body.get("labels") or {}))


def load_flows(pattern: str) -> list[Flow]:
    """Flow files by glob; YAML or JSON by extension, JSON when unknown.

    A file that cannot be read is reported and skipped; the others still load.
    """
    loaded = []
    for path in sorted(glob.glob(pattern, recursive=True)):
        try:
            with open(path, encoding="utf-8") as handle:
                text = handle.read()
            if path.endswith((".yaml", ".yml")):
                import yaml

                spec = yaml.safe_load(text)
            else:
                spec = json.loads(text)
            loaded.append(parse_flow(spec))
        except Exception as failure:
            log.error("skipping flow %s: %s", path, failure)
    return loaded


class _Run:
    """State of one flow run.

    ``batched`` marks rows that still count as row batches; ``form`` says what the
    payload is (``json`` or a declared ``record``), which its Spark type does not.
    """

    def __init__(self, spark: SparkSession, flow: Flow, bindings: Bindings):
        self.spark, self.flow, self.bindings = spark, flow, bindings
        self.result = Result()
        self.batched: str | None = None
        self.form = "json"
        self.batch: int | None = None
        self.durable: str | None = None

    def run_name(self, events: DataFrame) -> str | None:
        """What a batch of a stream writes under: the same when it is repeated."""
        if self.batch is None:
            return None
        query = events.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{query}-{self.batch}"

    def place(self, url: str) -> str:
        return self.bindings.root + file_source.object_path(url)

    def bound(self, task: Task) -> DataFrame:
        if task.name not in self.bindings.inputs:
            raise KeyError(f"no input bound for task {task.name!r}")
        return self.bindings.inputs[task.name]

    def good(self, task: Task, events: DataFrame) -> DataFrame:
        """Set error rows aside and continue with the rest."""
        if errors.ERROR not in events.columns:
            return events
        kept, failed = errors.split_errors(events)
        if self.batch is None:
            self.result.errors[task.name] = failed
            return kept
        # Within a streaming batch: error rows are landed, a repeated batch replaces its own.
        place = f"{self.bindings.checkpoints}/{self.flow.name}/errors/{task.name}"
        self.result.error_tables[task.name] = place
        payload = to_json_text(F.col("data"), failed.schema["data"].dataType)
        names = [c for c in (*COLUMNS, errors.ERROR) if c in failed.columns and c != "data"]
        failed.select(payload.alias("data"), *names).write.mode("overwrite").parquet(f"{place}/batch={self.batch}")
        return kept

    def own(self, task: Task, events: DataFrame) -> DataFrame:
        """Stamp like most tasks do: own name as subject, no id."""
        return restamp(
            events.select(*COLUMNS),
            task_id=task.task_id,
            task_type=task.type,
            subject=task.name,
            drop_id=True,
        )


def _generate(run: _Run, task: Task, _: None) -> DataFrame:
    config = task.config
    check_schedule(config.get("interval"), config.get("cron"))
    start, end, count = run.bindings.start, run.bindings.end, config.get("count")
    if config.get("cron") is not None:
        schedule = cron_schedule(run.spark, config["cron"], start, end=end, count=count)
    else:
        schedule = interval_schedule(run.spark, start, config["interval"], end=end, count=count)
    windows = run_windows(schedule, config.get("message"))
    system_info = F.struct("last_run_time", "next_run_time").alias("system_info")
    fields = [system_info] if config.get("message") is None else [F.col("message"), system_info]
    return windows.select(
        F.struct(*fields).alias("data"),
        F.lit(task.name).alias("subject"),
        F.lit(None).cast("string").alias("id"),
        (F.col("scheduled_at") * 1_000_000).alias("timestamp"),
        F.lit(task.task_id).alias("task_id"),
        F.lit(task.type).alias("task_type"),
    )


def _webhook(run: _Run, task: Task, _: None) -> DataFrame:
    """Judged requests, or raw ones that are judged here by the task's settings."""
    bound = run.bound(task)
    if "status" not in bound.columns:
        bound = ingest_requests(
            bound, credentials=run.bindings.credentials.get(task.name), allow_headers=list(task.config.get("headers") or {})
        )
    accepted = bound.where(F.col("status") == 200)
    return accepted.select(
        "data",
        F.lit(task.name).alias("subject"),
        F.lit(None).cast("string").alias("id"),
        "timestamp",
        F.lit(task.task_id).alias("task_id"),
        F.lit(task.type).alias("task_type"),
    )


def _message_subscriber(run: _Run, task: Task, _: None) -> DataFrame:
    """Messages of a subject; a durable name goes on after its stored cursor.

    ``max_messages`` and ``throttle`` size and space fetches of a live connection: a
    batch run takes all messages, a stream is paced by its source and ``delay``.
    """
    pattern = task.config.get("subject", ">")
    messages = _after_cursor(run, run.bound(task), task.config.get("durable_name"), pattern)
    return _received(run, task, subscribe(messages, pattern))


def _received(run: _Run, task: Task, messages: DataFrame) -> DataFrame:
    """Events of messages; a stream whose cursor is to be committed keeps its sequence."""
    kept = [*COLUMNS, "sequence"] if run.durable is not None else COLUMNS
    return restamp(messages.select(*kept), task_id=task.task_id, task_type=task.type)


def _after_cursor(run: _Run, messages: DataFrame, name: str | None, pattern: str, **options: bool) -> DataFrame:
    """Messages after the cursor of a durable name, which keeps the filter it began with.

    A batch run gives the cursor that follows it; a stream commits one with each of its
    batches where there is a store, and starts after the last one committed there.
    """
    run.durable = None
    if name is None:
        return messages
    store = run.bindings.cursor_store or (f"{run.bindings.checkpoints}/durable" if run.bindings.checkpoints else "")
    if store:
        bind_filter(run.spark, f"{store}/{name}", pattern)
    if "sequence" not in messages.columns:
        return messages
    if run.bindings.cursors is not None:
        messages = replay_from(messages, run.bindings.cursors, name, **options)
    if not messages.isStreaming:
        run.result.cursors[name] = advance_cursor(messages, name)
        return messages
    if not run.bindings.cursor_store or not options.get("enabled", True) or options.get("managed", False):
        return messages
    run.durable = name
    last = stored_cursor(run.spark, run.bindings.cursor_store, name)
    return messages if last is None else messages.where(F.col("sequence") > last)


def _topic_subscriber(run: _Run, task: Task, _: None) -> DataFrame:
    topic = task.config["topic"]
    name = topic["name"] if isinstance(topic, dict) else topic
    durable = (topic.get("durable_consumer_options") if isinstance(topic, dict) else None) or {}
    messages = _after_cursor(
        run,
        run.bound(task),
        durable.get("name"),
        name,
        enabled=durable.get("enabled", True),
        managed=durable.get("managed_subscription", False),
    )
    return _received(run, task, messages.withColumn("subject", source_subject(F.lit(name))))


def _convert(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    target = "record" if task.config.get("target_format", "json") == "avro" else task.config.get("target_format", "json")
    convert.check_conversion("batch" if run.batched == "rows" else run.form, target)
    if run.batched == "rows":
        # batch → JSON array; kept as rows because `iterate` would undo the array.
        run.batched = "array"
        return run.own(task, events)
    if target == "record":
        records = convert.to_record(events, task.config.get("schema"), form=run.form)
        run.form = "record"
        return run.own(task, run.good(task, records))
    run.form = "json"
    return run.own(task, convert.to_json_value(events))


def _iterate(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    if run.batched == "rows":
        raise ValueError("iterate needs a JSON payload: convert the batch first")
    key = task.config.get("iterate_key")
    if run.batched == "array":
        if key is not None:
            raise ValueError("a batch is a root array and has no keys")
        run.batched = None
        return run.own(task, events)
    run.form = "json"
    spread = iterate(events, key, name=task.name)
    return run.own(task, run.good(task, spread))


def _script(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    step = {
        "map": script.script_map,
        "filter": script.script_filter,
        "fanout": script.script_fanout,
        "envelope": script.script_envelope,
    }[task.config.get("mode", "map")]
    if step is not script.script_filter:
        run.form = "json"
    return restamp(step(events, task.config["code"]), task_id=task.task_id, task_type=task.type)


def _log(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    passed, seen = tap(
        events, task.config.get("level", "info"), f"{run.flow.name}.{task.name}", structured=task.config.get("structured", False)
    )
    run.result.observations[task.name] = seen
    return passed.withColumns(
        {"task_id": F.lit(task.task_id), "id": F.lit(None).cast("string")}
    )


def _reader(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    """Read what the trigger points to: one path per run, or one document per event.

    A fixed path is read once if there is any trigger, and not at all without one.
    """
    path = task.config["path"]
    run.form = "json"
    if "{{" in path:
        documents = file_source.read_from_events(
            run.spark,
            events,
            path,
            name=task.name,
            root=run.bindings.root,
            has_header=task.config.get("has_header", True),
            delimiter=task.config.get("delimiter") or ",",
        )
        return run.own(task, run.good(task, documents))
    place = run.place(path)
    if place.endswith(".json") or task.config.get("format") == "json":
        rows = file_source.read_json_docs(run.spark, place)
    elif place.endswith(".csv") or task.config.get("format") == "csv":
        rows = file_source.read_csv_typed(
            run.spark,
            place,
            has_header=task.config.get("has_header", True),
            delimiter=task.config.get("delimiter") or ",",
        )
        names = [c for c in rows.columns if c != errors.ERROR]
        rows = rows.select(F.struct(*names).alias("data"), errors.ERROR)
        run.batched = "rows"
    else:
        rows = file_source.read_avro(run.spark, place)
        rows = rows.select(F.struct(*rows.columns).alias("data"))
        run.form = "record"
    if not events.isStreaming:
        # One row at most is broadcast.
        triggered = F.broadcast(events.limit(1).select(F.lit(True).alias("_triggered")))
        rows = rows.withColumn("_triggered", F.lit(True)).join(triggered, "_triggered", "left_semi").drop("_triggered")
    stamped = rows.withColumns(
        {
            "subject": F.lit(task.name),
            "id": F.lit(None).cast("string"),
            "timestamp": F.unix_micros(F.current_timestamp()),
            "task_id": F.lit(task.task_id),
            "task_type": F.lit(task.type),
        }
    )
    return run.good(task, stamped).select(*COLUMNS)


def _writer(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    """One partitioned write; the varying part of the path is a partition column."""
    template = task.config["path"]
    head, tag, _ = template.partition("{{")
    static = head.rpartition("/")[0] if tag else template
    partitions = []
    if tag:
        varying = template[len(static) :].lstrip("/")
        events = events.withColumn("destination", file_sink.templated_path(varying, events))
        partitions.append("destination")
    hive = task.config.get("hive_partition_options") or {}
    if hive.get("enabled"):
        events = file_sink.with_event_date(events)
        partitions += list(file_sink.DATE_PARTITIONS)
    place = run.place(static)
    form = "csv" if run.batched else ("parquet" if run.form == "record" else "json")
    form = task.config.get("format", form)
    run.form = "json"
    kind = events.schema["data"].dataType
    payload = kind if isinstance(kind, T.StructType) else None
    write = lambda rows, folder: file_sink.write_events(rows, folder, form, partition_by=partitions, mode="overwrite")
    receipts = file_sink.write_run(events, place, form, write, run=run.run_name(events), payload=payload)
    run.result.written[task.name] = place
    run.batched = None
    return _as_events(task, receipts, F.struct("status", "path", "e_tag", "rows"), id="e_tag")


def _as_events(task: Task, rows: DataFrame, data: Any, *, id: str | None = None) -> DataFrame:
    return rows.select(
        data.alias("data"),
        F.lit(task.name).alias("subject"),
        (F.lit(None).cast("string") if id is None else F.col(id)).alias("id"),
        F.unix_micros(F.current_timestamp()).alias("timestamp"),
        F.lit(task.task_id).alias("task_id"),
        F.lit(task.type).alias("task_type"),
    )


def _message_publisher(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    stream = (task.config.get("stream") or {}).get("name", task.name)
    window = (task.config.get("stream") or {}).get("duplicate_window_secs")
    place = run.bindings.message_tables.get(stream)
    window = None if window is None else window * 1_000_000
    run.form = "json"
    if place is None:
        messages = publish(events, stream, task.config["subject"], duplicate_window=window)
    else:
        messages = publish_batch(events, place, stream, task.config["subject"], batch=run.run_name(events), duplicate_window=window)
        run.result.written[task.name] = place
        run.result.streams[stream] = _held(run, task, run.spark.read.schema(messages.drop("duplicate").schema).parquet(place).drop("batch"))
    return _as_events(task, messages, F.struct("stream", "sequence", "domain", "duplicate"))


def _held(run: _Run, task: Task, messages: DataFrame) -> DataFrame:
    """Messages of a stream that its declared limits keep; the table itself only grows."""
    options = task.config.get("stream") or {}
    limits = Limits(
        max_age_secs=options.get("max_age_secs"),
        max_messages_per_subject=options.get("max_messages_per_subject"),
        max_messages=options.get("max_messages"),
        max_bytes=options.get("max_bytes"),
        max_message_size=options.get("max_message_size"),
        discard=str(options.get("discard") or "old").lower(),
    )
    if limits.max_bytes is not None or limits.max_message_size is not None:
        text = to_json_text(F.col("data"), messages.schema["data"].dataType)
        messages = messages.withColumn("bytes", F.octet_length(text).cast("bigint"))
    return retain(messages, limits, now=F.unix_micros(F.current_timestamp())).drop("bytes")


def _request(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    rendered = run.good(task, requests.render_requests(events, task.config))
    run.form = "json"
    if task.name in run.bindings.responses:
        answered = run.bindings.responses[task.name](rendered)
        return run.own(task, requests.parse_responses(answered))
    request = F.struct("method", "endpoint", "headers", "body")
    return run.own(task, rendered.withColumn("data", request))


def _topic_publisher(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    records = requests.publish_records(events, task.config["payload"], task.config["schema"])
    run.form = "record"
    named = run.good(task, records).withColumn("subject", publish_subject(F.lit(task.config["topic"])))
    return restamp(named.select(*COLUMNS), task_id=task.task_id, task_type=task.type)


def _bulk_export(run: _Run, task: Task, events: DataFrame) -> DataFrame:
    """The query is Spark SQL over registered tables; a deleted flag column is optional."""
    if task.config.get("operation", "query") not in export.OPERATIONS:
        raise NotImplementedError(f"bulk operation {task.config['operation']!r}")
    rows = run.spark.sql(task.config["query"])
    flag = task.config.get("deleted", "is_deleted")
    if flag not in rows.columns:
        rows = rows.withColumn(flag, F.lit(False))
    place = run.place(task.config["path"])
    exported = [c for c in rows.columns if c != flag]
    payload = T.StructType([rows.schema[c] for c in exported])
    # A later run, or batch, adds its own folder.
    write = lambda rows, folder: export.bulk_export(
        rows,
        folder,
        exported,
        operation=task.config.get("operation", "query"),
        deleted=flag,
        delimiter=task.config.get("column_delimiter", "COMMA"),
        line_ending=task.config.get("line_ending", "LF"),
        mode="overwrite",
    )
    receipts = file_sink.write_run(rows, place, "csv", write, run=run.run_name(events), payload=payload)
    run.result.written[task.name] = place
    run.form = "json"
    return _as_events(task, receipts, F.struct("status", "path", "e_tag", "rows"), id="e_tag")


_STEPS: dict[str, Callable[..., DataFrame]] = {
    "convert": _convert,
    "iterate": _iterate,
    "log": _log,
    "script": _script,
    "object_store_reader": _reader,
    "object_store_writer": _writer,
    "generate": _generate,
    "http_request": _request,
    "http_webhook": _webhook,
    "nats_jetstream_subscriber": _message_subscriber,
    "nats_jetstream_publisher": _message_publisher,
    "salesforce_pubsub_subscriber": _topic_subscriber,
    "salesforce_pubsub_publisher": _topic_publisher,
    "salesforce_bulkapi_job_creator": _bulk_export,
}

# Steps that act on row batches as such; for any other step a batch is one JSON array.
_BATCH_AWARE = ("convert", "iterate", "log", "object_store_writer")


def run_flow(spark: SparkSession, flow: Flow, bindings: Bindings | None = None) -> Result:
    """Run every segment.  Only sinks start jobs; the rest stays one lazy plan.

    With a stream as input and a sink in the segment, the steps before the first sink
    or the first step that can set rows aside are one streaming plan, and what follows
    runs on every batch; error rows are landed per batch under the checkpoints.  A
    batch that is repeated after a failure replaces the files it wrote, and a message
    table numbers it once.  Cursors are committed with the batch that reached them.
    """
    run = _Run(spark, flow, bindings or Bindings())
    for segment in flow.segments():
        events: DataFrame | None = None
        run.batched, run.form, run.durable = None, "json", None
        sinks = any(task.type in SINK_TYPES for task in segment)
        for position, task in enumerate(segment):
            per_batch = run.durable is not None or task.type in SINK_TYPES + MARKING_TYPES
            if events is not None and events.isStreaming and sinks and per_batch:
                run.result.queries[task.name] = _stream_into(run, events, segment[position:])
                break
            events = _step(run, task, events)
        run.result.outputs.append(events)
    return run.result


def _step(run: _Run, task: Task, events: DataFrame | None) -> DataFrame:
    if run.batched and task.type not in _BATCH_AWARE:
        raise ValueError(
            f"task {task.name!r} needs single events: convert the batch to json and iterate it first"
        )
    return _STEPS[task.type](run, task, events)


def _stream_into(run: _Run, events: DataFrame, tasks: list[Task]) -> Any:
    if not run.bindings.checkpoints:
        raise ValueError("streaming inputs need a checkpoint folder")

    batched, form = run.batched, run.form
    pace = next((t.config["delay"] for t in run.flow.tasks if t.is_source and t.config.get("delay")), None)

    durable = run.durable

    def each(batch: DataFrame, number: int) -> None:
        own = _Run(batch.sparkSession, run.flow, run.bindings)
        own.result, own.batched, own.form, own.batch = run.result, batched, form, number
        # Error rows, sinks and the cursor all read it.
        held = batch.persist()
        try:
            events = held if durable is None else held.select(*COLUMNS)
            for task in tasks:
                events = _step(own, task, events)
            last = None if durable is None else held.agg(F.max("sequence")).first()[0]
            if last is not None:
                commit_cursor(own.spark, run.bindings.cursor_store, durable, last, own.run_name(held))
        finally:
            held.unpersist()

    home = f"{run.bindings.checkpoints}/{run.flow.name}/{tasks[0].name}"
    return for_each_batch(events, each, home, once=run.bindings.once, delay=pace)
