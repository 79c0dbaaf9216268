"""Runs and batches that are repeated, cursors of streams, many subscriptions at once."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.subjects import subject_matches
from millrace.plans.flow import Bindings, parse_flow, run_flow
from millrace.sinks import publish as P
from millrace.sinks.files import write_events, write_run
from millrace.sources.messages import commit_cursor, stored_cursor, subscribe_many


def batch(spark, *rows):
    df = spark.createDataFrame([(i, s * 1_000_000) for i, s in rows], "id string, timestamp bigint")
    return df.select(
        F.struct(F.col("id").alias("k")).alias("data"), F.lit("in.x").alias("subject"), "id", "timestamp",
        F.lit(0).alias("task_id"), F.lit("t").alias("task_type"),
    )


def send(spark, path, name, *rows, window=10_000_000):
    acks = P.publish_batch(batch(spark, *rows), path, "st", "out.{{event.data.k}}", batch=name, duplicate_window=window)
    return sorted((r["sequence"], r["duplicate"]) for r in acks.collect())


def test_replayed_batch_keeps_its_numbers(spark, tmp_path):
    path = str(tmp_path / "st")
    first = send(spark, path, "1", ("a", 0), ("b", 1), ("a", 5))
    assert first == [(1, False), (1, True), (2, False)]
    second = send(spark, path, "2", ("a", 9), ("c", 9))
    assert second == [(1, True), (3, False)]
    # Replays, also of an older batch: the same numbers, nothing appended.
    assert send(spark, path, "2", ("a", 9), ("c", 9)) == second
    assert send(spark, path, "1", ("a", 0), ("b", 1), ("a", 5)) == first
    assert sorted(r["sequence"] for r in P.read_messages(spark, path).collect()) == [1, 2, 3]
    assert [(e.number, e.batch, e.last) for e in P.ledger(spark, path)] == [(0, "1", 2), (1, "2", 3)]
    # A batch of repeats alone, and an empty one, leave the numbers where they are.
    assert send(spark, path, "3-x", ("c", 10)) == [(3, True)]
    assert send(spark, path, "4") == []
    assert send(spark, path, "5", ("z", 99)) == [(4, False)]


def test_batch_that_failed_before_its_entry_is_written_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "st")
    send(spark, path, "1", ("a", 0))
    made = spark.createDataFrame([(9, "out.zz", "zz", 5_000_000)], "sequence long, subject string, id string, timestamp long")
    # Messages without a ledger entry: not read, not counted, replaced by the batch itself.
    P.read_messages(spark, path).limit(0).unionByName(made, allowMissingColumns=True).write.parquet(f"{path}/batch=b-2")
    assert [r["sequence"] for r in P.read_messages(spark, path).collect()] == [1]
    assert send(spark, path, "2", ("zz", 6)) == [(2, False)]
    assert sorted(r["sequence"] for r in P.read_messages(spark, path).collect()) == [1, 2]


def test_numbers_do_not_come_from_the_messages(spark, tmp_path):
    path = str(tmp_path / "st")
    send(spark, path, "1", ("a", 0), window=None)
    for file in (tmp_path / "st" / "batch=b-1").glob("*.parquet"):
        file.write_bytes(b"not parquet any more")
    assert P.ledger(spark, path)[0].last == 1
    acks = P.publish_batch(batch(spark, ("b", 1)), path, "st", "x", batch="2")
    assert [r["sequence"] for r in acks.collect()] == [2]


def test_run_writes_and_reads_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "lake")
    write = lambda rows, folder: write_events(rows, folder, "json", mode="overwrite")
    rows = lambda n: spark.range(n).select(F.struct("id").alias("data"))
    assert sum(r["rows"] for r in write_run(rows(5), path, "json", write, run="a").collect()) == 5
    (tmp_path / "lake" / "run=broken").mkdir()
    (tmp_path / "lake" / "run=broken" / "part.json").write_bytes(b"\xff\xfe")
    again = write_run(rows(7), path, "json", write, run="b").collect()
    assert sum(r["rows"] for r in again) == 7 and all("/run=b/" in r["path"] for r in again)
    assert sum(r["rows"] for r in write_run(rows(3), path, "json", write, run="a").collect()) == 3
    assert write_run(rows(0), path, "json", write).count() == 0
    assert spark.read.text(f"{path}/run=a").count() == 3


# --- cursors ------------------------------------------------------------------


def flow(pattern="in.>"):
    subscriber = {"nats_jetstream_subscriber": {"name": "sub", "subject": pattern, "durable_name": "reader"}}
    sink = {"object_store_writer": {"name": "w", "path": "file:///land"}}
    return parse_flow({"flow": {"name": "f", "tasks": [subscriber, {"script": {"name": "s", "mode": "filter", "code": "true"}}, sink]}})


def messages(spark, folder, *sequences):
    df = spark.createDataFrame([(s,) for s in sequences], "sequence long").select(
        F.struct("sequence").alias("data"), F.concat(F.lit("in."), (F.col("sequence") % 2).cast("string")).alias("subject"),
        F.col("sequence").cast("string").alias("id"), F.col("sequence").alias("timestamp"), F.lit(0).alias("task_id"), F.lit("t").alias("task_type"), "sequence",
    )
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def test_stream_commits_and_honours_its_cursor(spark, tmp_path):
    inbox, store = str(tmp_path / "in"), str(tmp_path / "cursors")
    schema = messages(spark, inbox, 1, 2, 3)

    def drain(checkpoints, pattern="in.>"):
        stream = spark.readStream.schema(schema).parquet(inbox)
        bindings = Bindings(inputs={"sub": stream}, root=str(tmp_path), checkpoints=str(tmp_path / checkpoints), cursor_store=store)
        for query in run_flow(spark, flow(pattern), bindings).queries.values():
            query.awaitTermination()
        return sorted(r["sequence"] for r in spark.read.json(str(tmp_path / "land")).collect())

    assert drain("one") == [1, 2, 3] and stored_cursor(spark, store, "reader") == 3
    messages(spark, inbox, 4, 5)
    assert drain("one") == [1, 2, 3, 4, 5] and stored_cursor(spark, store, "reader") == 5
    # Without its checkpoint the stream still starts after the cursor.
    messages(spark, inbox, 6)
    assert drain("two") == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError, match="bound to"):
        drain("one", "in.1")
    # A batch flow under the name is held to the same filter.
    with pytest.raises(ValueError, match="bound to"):
        run_flow(spark, flow("in.0"), Bindings(inputs={"sub": spark.read.parquet(inbox)}, root=str(tmp_path), cursor_store=store))


def test_cursor_commits_replace_their_own(spark, tmp_path):
    store = str(tmp_path)
    assert stored_cursor(spark, store, "n") is None
    commit_cursor(spark, store, "n", 7, "q-0")
    commit_cursor(spark, store, "n", 9, "q-1")
    commit_cursor(spark, store, "n", 9, "q-1")
    assert stored_cursor(spark, store, "n") == 9
    assert len(list((tmp_path / "n").glob("commit=*"))) == 2


def test_streaming_publish_numbers_once(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), str(tmp_path / "st")
    schema = messages(spark, inbox, 1, 2)
    subscriber = {"nats_jetstream_subscriber": {"name": "sub", "subject": "in.>"}}
    publisher = {"nats_jetstream_publisher": {"name": "p", "subject": "out.x", "stream": {"name": "st"}}}
    published = parse_flow({"flow": {"name": "g", "tasks": [subscriber, publisher]}})

    def drain():
        stream = spark.readStream.schema(schema).parquet(inbox)
        bindings = Bindings(inputs={"sub": stream}, message_tables={"st": table}, checkpoints=str(tmp_path / "cp"))
        for query in run_flow(spark, published, bindings).queries.values():
            query.awaitTermination()
        return sorted(r["sequence"] for r in P.read_messages(spark, table).collect())

    assert drain() == [1, 2]
    messages(spark, inbox, 3)
    assert drain() == [1, 2, 3]
    # The last batch's commit is lost: Spark runs it again, under the same name.
    last = max((tmp_path / "cp" / "g" / "p" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert drain() == [1, 2, 3]


# --- subscriptions ------------------------------------------------------------

PATTERNS = {
    "all": ">", "a": "a.>", "ab": "a.b", "star": "a.*", "mid": "a.*.c", "tail": "a.*.>", "first": "*.b", "same": "a.b", "deep": "a.b.c.d", "two": "*.*", "plain": "x",
    "dots": "a.+.c",
}
SUBJECTS = ["a", "a.b", "a.c", "a.b.c", "a.x.c", "a.b.c.d", "x", "x.b", "a.", ".b", "a..c", "", None, "a.+.c", "a.*", "*.b", "a.b.", "A.b"]


def test_subscribe_many(spark):
    messages = spark.createDataFrame([(n, s) for n, s in enumerate(SUBJECTS)], "n long, subject string")
    got = sorted((r["durable_name"], r["n"]) for r in subscribe_many(messages, PATTERNS).collect())
    expected = sorted(
        (name, r["n"]) for name, pattern in PATTERNS.items() for r in messages.where(subject_matches(F.col("subject"), pattern)).collect()
    )
    assert got == expected and len(got) > 30
    assert subscribe_many(messages, {}).count() == 0
    with pytest.raises(ValueError):
        subscribe_many(messages, {"bad": "a..b"})


def test_subscribe_many_reads_once(spark, tmp_path):
    spark.range(100).select(F.col("id"), F.concat(F.lit("s."), (F.col("id") % 40).cast("string")).alias("subject")).write.parquet(str(tmp_path / "m"))
    patterns = {f"n{i}": f"s.{i}" for i in range(500)} | {"every": "s.*"}
    df = subscribe_many(spark.read.parquet(str(tmp_path / "m")), patterns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and df.count() == 200
