import json

import pytest
from pyspark.sql import functions as F

from millrace.plans.flow import Bindings, load_flows, parse_flow, run_flow
from millrace.sinks.export import bulk_export, bulk_select
from millrace.sinks.files import object_name, templated_path, with_event_date, write_events, write_receipts, write_split
from millrace.sources.files import (
    infer_csv_schema,
    object_path,
    read_avro,
    read_csv_typed,
    read_from_events,
    read_json_docs,
    read_json_lines,
    read_objects,
)


def spec(*tasks, name="f"):
    return {"flow": {"name": name, "tasks": list(tasks), "unknown_field": 1}}


def events(spark, *payloads):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "n bigint, text string")
    return rows.select(
        F.parse_json("text").alias("data"), F.concat(F.lit("in."), F.col("n").cast("string")).alias("subject"),
        F.col("n").cast("string").alias("id"), (F.col("n") * 86_400_000_000 + 1_704_067_200_000_000).alias("timestamp"),
        F.lit(0).alias("task_id"), F.lit("test").alias("task_type"),
    )


SUBSCRIBE = {"nats_jetstream_subscriber": {"name": "sub", "subject": "in.>"}}


# --- composition ------------------------------------------------------------


def test_segments():
    flow = parse_flow(
        spec(
            {"log": {"name": "never"}},
            SUBSCRIBE,
            {"script": {"name": "a", "code": "data"}},
            {"generate": {"name": "gen", "interval": "1s", "count": 1}},
            {"log": {"name": "b"}},
        )
    )
    assert [[t.name for t in s] for s in flow.segments()] == [["sub", "a"], ["gen", "b"]]
    assert [t.task_id for t in flow.tasks] == [0, 1, 2, 3, 4]


def test_segments_do_not_feed_each_other(spark):
    flow = parse_flow(
        spec(SUBSCRIBE, {"generate": {"name": "gen", "interval": "10s", "count": 2, "message": "hi"}}, {"log": {"name": "l"}})
    )
    result = run_flow(spark, flow, Bindings(inputs={"sub": events(spark, "1")}, start=100))
    subscribed, generated = result.outputs
    assert [(r["task_id"], r["task_type"], r["id"]) for r in subscribed.collect()] == [(0, "nats_jetstream_subscriber", "0")]
    rows = sorted(generated.collect(), key=lambda r: r["timestamp"])
    # log keeps subject and type of the task before it and drops the id
    assert [(r["subject"], r["task_id"], r["task_type"], r["id"]) for r in rows] == [("gen", 2, "generate", None)] * 2
    assert [r["data"].asDict(True) for r in rows] == [
        {"message": "hi", "system_info": {"last_run_time": None, "next_run_time": 110}},
        {"message": "hi", "system_info": {"last_run_time": 100, "next_run_time": None}},
    ]
    assert result.observations["l"].get["events"] == 2


def test_unknown_task_type_and_unbound_source(spark):
    with pytest.raises(ValueError, match="unknown task type"):
        parse_flow(spec({"teleport": {"name": "x"}}))
    with pytest.raises(KeyError):
        run_flow(spark, parse_flow(spec(SUBSCRIBE)))


def test_errors_are_set_aside(spark):
    flow = parse_flow(
        spec(
            SUBSCRIBE,
            {"iterate": {"name": "items", "iterate_key": "items"}},
            {"convert": {"name": "rec", "target_format": "avro", "schema": '{"type":"record","name":"R","fields":[{"name":"a_b","type":"int"}]}'}},
        )
    )
    bound = events(spark, '{"items":[{"a-b":1},{"a-b":"x"}]}', '{"none":1}')
    result = run_flow(spark, flow, Bindings(inputs={"sub": bound}))
    out = result.outputs[0].collect()
    assert [(r["data"]["a_b"], r["subject"], r["id"], r["task_id"]) for r in out] == [(1, "rec", None, 2)]
    assert [r["_error"] for r in result.errors["items"].collect()] == ["KeyNotFound"]
    assert [r["_error"] for r in result.errors["rec"].collect()] == ["SchemaMismatch"]


def test_batch_rules(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,name\n1,x\n2,y\n")
    read = [{"generate": {"name": "g", "interval": "1s", "count": 1}}, {"object_store_reader": {"name": "r", "path": "file:///in/a.csv"}}]
    bindings = Bindings(root=str(tmp_path))
    with pytest.raises(ValueError, match="UnsupportedConversion"):
        run_flow(spark, parse_flow(spec(*read, {"convert": {"name": "c", "target_format": "avro", "schema": '"string"'}})), bindings)
    with pytest.raises(ValueError, match="JSON"):
        run_flow(spark, parse_flow(spec(*read, {"iterate": {"name": "i"}})), bindings)
    with pytest.raises(ValueError, match="single events"):
        run_flow(spark, parse_flow(spec(*read, {"script": {"name": "s", "code": "data"}})), bindings)
    flow = parse_flow(spec(*read, {"convert": {"name": "c"}}, {"iterate": {"name": "i"}}))
    rows = run_flow(spark, flow, bindings).outputs[0].collect()
    assert [tuple(r["data"]) for r in rows] == [(1, "x"), (2, "y")] and {r["subject"] for r in rows} == {"i"}


def test_requests_and_responses_in_a_flow(spark):
    task = {"http_request": {"name": "call", "endpoint": "http://h/{{event.id}}", "method": "POST", "payload": {"from_event": True}}}
    flow = parse_flow(spec(SUBSCRIBE, task))
    bound = {"sub": events(spark, '{"a":1}')}
    row = run_flow(spark, flow, Bindings(inputs=bound)).outputs[0].first()
    assert (row["data"]["endpoint"], row["data"]["body"], row["subject"]) == ("http://h/0", '{"a":1}', "call")
    answer = Bindings(inputs=bound, responses={"call": lambda r: r.withColumn("body", F.concat(F.lit('{"got":'), "body", F.lit("}")))})
    out = run_flow(spark, flow, answer).outputs[0]
    assert out.select(F.to_json("data").alias("t")).first()["t"] == '{"got":{"a":1}}'


def test_topic_flow(spark):
    flow = parse_flow(
        spec(
            {"salesforce_pubsub_subscriber": {"name": "sub", "topic": {"name": "/data/AccountChangeEvent"}}},
            {
                "salesforce_pubsub_publisher": {
                    "name": "pub", "topic": "/event/Out__e", "payload": {"Name": "{{event.subject}}"},
                    "schema": '{"type":"record","name":"O","fields":[{"name":"Name","type":"string"},{"name":"CreatedDate","type":"long"}]}',
                }
            },
        )
    )
    row = run_flow(spark, flow, Bindings(inputs={"sub": events(spark, "{}")})).outputs[0].first()
    assert (row["subject"], row["data"]["Name"], row["task_id"]) == ("event.out__e", "accountchangeevent", 1)


def test_templated_landing_and_bulk_export(spark, tmp_path):
    root = str(tmp_path)
    flow = parse_flow(
        spec(
            SUBSCRIBE,
            {
                "object_store_writer": {
                    "name": "w", "path": "s3://bucket/land/{{event.subject}}",
                    "hive_partition_options": {"enabled": True, "partition_keys": ["EventDate"]},
                }
            },
        )
    )
    result = run_flow(spark, flow, Bindings(inputs={"sub": events(spark, '{"a":1}', '{"a":2}')}, root=root))
    receipts = result.outputs[0].collect()
    assert result.written["w"] == root + "/land"
    assert {r["data"]["status"] for r in receipts} == {"success"} and all(r["id"] == r["data"]["e_tag"] for r in receipts)
    # Below a folder of the run's own.
    inside = [r["data"]["path"].split("/land/")[1].partition("/") for r in receipts]
    assert len({run for run, _, _ in inside}) == 1 and inside[0][0].startswith("run=")
    assert sorted(path.rsplit("/", 1)[0] for _, _, path in inside) == [
        "destination=in.0/year=2024/month=1/day=1", "destination=in.1/year=2024/month=1/day=2"
    ]
    # A second run appends; its receipts are about its own files only.
    again = run_flow(spark, flow, Bindings(inputs={"sub": events(spark, '{"a":3}')}, root=root))
    fresh = {r["data"]["path"] for r in again.outputs[0].collect()}
    assert len(fresh) == 1 and not fresh & {r["data"]["path"] for r in receipts}
    spark.createDataFrame([(1, False), (2, True)], "id int, is_deleted boolean").createOrReplaceTempView("accounts")
    task = {"name": "b", "query": "SELECT * FROM accounts", "path": "file:///out", "column_delimiter": "TAB", "line_ending": "CRLF"}
    result = run_flow(
        spark,
        parse_flow(spec({"generate": {"name": "g", "interval": "1s", "count": 1}}, {"salesforce_bulkapi_job_creator": task})),
        Bindings(root=root),
    )
    assert [r["data"]["rows"] for r in result.outputs[0].collect()] == [1]
    task.update(operation="insert", path="file:///out2")
    with pytest.raises(NotImplementedError):
        run_flow(spark, parse_flow(spec({"generate": {"name": "g", "interval": "1s", "count": 1}}, {"salesforce_bulkapi_job_creator": task})), Bindings(root=root))


def test_load_flows_skips_bad_files(tmp_path):
    (tmp_path / "a.yaml").write_text("flow:\n  name: a\n  tasks:\n    - log: {name: l, extra: 1}\n")
    (tmp_path / "b.json").write_text(json.dumps(spec({"log": {"name": "l"}}, name="b")))
    (tmp_path / "c.conf").write_text(json.dumps(spec({"log": {"name": "l"}}, name="c")))
    (tmp_path / "d.yaml").write_text("flow: [")
    (tmp_path / "e.json").write_text('{"flow": {"name": "e"}}')
    assert [f.name for f in load_flows(str(tmp_path / "*"))] == ["a", "b", "c"]


# --- files ------------------------------------------------------------------


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id;name;when\n" + "".join(f"{i};n{i};2024-01-01\n" for i in range(150)) + "bad;n;2024-01-02\n")
    schema = infer_csv_schema(spark, str(path), delimiter=";;ignored")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("id", "bigint"), ("name", "string"), ("when", "date")]
    df = read_csv_typed(spark, str(path), delimiter=";")
    assert df.where("_error is null").count() == 150
    assert [r["_error"] for r in df.where("_error is not null").collect()] == ["SchemaMismatch"]
    short = tmp_path / "short"
    short.mkdir()
    for n in range(3):
        (short / f"{n}.csv").write_text(f"id,x\n{n},1.5\n")
    assert [f.dataType.simpleString() for f in infer_csv_schema(spark, str(short))] == ["bigint", "double"]
    bare = tmp_path / "b.csv"
    bare.write_text("1,x\n2,y\n")
    assert read_csv_typed(spark, str(bare), has_header=False).count() == 2


def test_json_documents_and_mixed_folder(spark, tmp_path, caplog):
    (tmp_path / "a.json").write_text('{\n "depot": "north",\n "gates": [4, 5]\n}')
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "d.txt").write_text("skipped")
    docs = read_json_docs(spark, str(tmp_path))
    assert sorted((r["path"][-6:], r["_error"]) for r in docs.collect()) == [("a.json", None), ("b.json", "InvalidJson")]
    objects = read_objects(spark, str(tmp_path))
    found = sorted(r["t"] for r in objects.where("_error is null").select(F.to_json("data").alias("t")).collect())
    assert found == ['{"depot":"north","gates":[4,5]}', '{"id":1,"name":"x"}', '{"id":2,"name":"y"}']
    assert "unsupported extensions, such as txt" in caplog.text
    (tmp_path / "README").write_text("x")
    with pytest.raises(ValueError, match="no extension"):
        read_objects(spark, str(tmp_path))


def test_avro_needs_its_module(spark, tmp_path):
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_avro(spark, str(tmp_path))


def test_read_from_events(spark, tmp_path):
    for n in (0, 1, 2):
        (tmp_path / f"doc{n}.json").write_text(f'{{"n":{n}}}')
    (tmp_path / "rows.csv").write_text('a,b\n1,"x, ""y""\nz"\n2,w\n')
    (tmp_path / "other.csv").write_text("b,c\nq,5\n")
    (tmp_path / "note.txt").write_text("x")
    names = ["doc0.json", "doc1.json", "doc1.json", "rows.csv", "other.csv", "gone.json", "note.txt", "bare"]
    triggers = events(spark, *[f'{{"f":"{n}"}}' for n in names])
    out = read_from_events(spark, triggers, "s3://bucket/{{event.data.f}}", name="rd", root=str(tmp_path)).collect()
    good = sorted(str(json.loads(r["data"].toJson())) for r in out if r["_error"] is None)
    rows = [{"a": 1, "b": 'x, "y"\nz'}, {"a": 2, "b": "w"}, {"b": "q", "c": 5}, {"n": 0}, {"n": 1}, {"n": 1}]
    assert good == sorted(map(str, rows))
    assert sorted((r["path"], r["_error"]) for r in out if r["_error"]) == [
        ("/bare", "NoExtension"), ("/gone.json", "NotFound"), ("/note.txt", "UnsupportedExtension")
    ]
    assert object_path("s3://bucket/a/b") == "/a/b" and object_path("/a/b") == "/a/b"


def test_write_formats_and_receipts(spark, tmp_path):
    df = events(spark, '{"a":1,"b":null}', '{"a":2}')
    write_events(df, str(tmp_path / "j"), "json")
    back = read_json_lines(spark, str(tmp_path / "j"))
    assert sorted(r["t"] for r in back.select(F.to_json("data").alias("t")).collect()) == ['{"a":1,"b":null}', '{"a":2}']
    with pytest.raises(ValueError, match="record"):
        write_events(df, str(tmp_path / "c"), "csv")
    dated = with_event_date(df)
    write_events(dated, str(tmp_path / "p"), "json", partition_by=["year", "month", "day"])
    assert (tmp_path / "p" / "year=2024" / "month=1" / "day=2").exists()
    receipts = write_receipts(spark, str(tmp_path / "p"), "json").collect()
    assert len(receipts) == 2 and len({r["e_tag"] for r in receipts}) == 2 and sum(r["rows"] for r in receipts) == 2
    assert with_event_date(df, None).first()["year"] >= 2024
    names = [r["n"] for r in df.select(object_name("batch").alias("n")).collect()]
    assert names == ["0.csv", "1.csv"]
    assert df.select(templated_path("file:///x/{{event.subject}}", df).alias("p")).first()["p"] == "/x/in.0"


def test_write_split_lands_both_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "InvalidJson")], "id int, _error string")
    write_split(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r["id"], r["outcome"]) for r in back.collect()) == [(1, "good"), (2, "error")]


def test_bulk_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", False), (2, "b", True)], "id int, name string, is_deleted boolean")
    assert bulk_select(df, ["id"]).count() == 1 and bulk_select(df, ["id"], "queryAll").count() == 2
    for name, separator in (("COMMA", ","), ("TAB", "\t"), ("SEMICOLON", ";"), ("PIPE", "|"), ("CARET", "^"), ("BACKQUOTE", "`")):
        out = tmp_path / name
        bulk_export(df.coalesce(1), str(out), ["id", "name"], delimiter=name, line_ending="CRLF")
        text = b"".join(p.read_bytes() for p in out.glob("part-*"))
        assert text == f"id{separator}name\r\n1{separator}a\r\n".encode()
    with pytest.raises(NotImplementedError):
        bulk_select(df, ["id"], "upsert")


def test_partitioned_write_rebalances_a_hot_value(spark, tmp_path):
    """A value holding most rows is written by several tasks, most others by one.

    A rare value may share the hot value's shuffle partition and be split with it.
    """
    df = spark.range(0, 60_000, 1, 8).select(
        F.struct(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).alias("data"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 90).cast("string"))).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        write_events(df, str(tmp_path / "p"), "parquet", partition_by=["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {f"d{n}": len(list((tmp_path / "p" / f"day=d{n}").glob("*.parquet"))) for n in range(0, 90, 3)}
    files["hot"] = len(list((tmp_path / "p" / "day=hot").glob("*.parquet")))
    assert files["hot"] > 1 and sorted(files.values())[20] == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 60_000


def test_publish_goes_on_after_stored_messages(spark, tmp_path):
    task = {"nats_jetstream_publisher": {"name": "p", "subject": "out.{{event.data.k}}", "stream": {"name": "st", "duplicate_window_secs": 10}}}
    flow = parse_flow(spec(SUBSCRIBE, task))
    table = str(tmp_path / "st")

    def send(*rows):
        df = spark.createDataFrame([(i, s * 1_000_000) for i, s in rows], "id string, timestamp bigint").select(
            F.struct(F.col("id").alias("k")).alias("data"), F.lit("in.x").alias("subject"), "id", "timestamp",
            F.lit(0).alias("task_id"), F.lit("t").alias("task_type"),
        )
        out = run_flow(spark, flow, Bindings(inputs={"sub": df}, message_tables={"st": table})).outputs[0]
        return sorted((r["data"]["sequence"], r["data"]["duplicate"]) for r in out.collect())

    assert send(("a", 0), ("b", 1), ("a", 5)) == [(1, False), (1, True), (2, False)]
    # "a" at 9 repeats message 1, at 10 it is new, at 15 it repeats that one.
    assert send(("a", 9), ("a", 10), ("a", 15), ("c", 9)) == [(1, True), (3, False), (4, False), (4, True)]
    stored = spark.read.parquet(table).orderBy("sequence").collect()
    assert [(r["sequence"], r["subject"]) for r in stored] == [(1, "out.a"), (2, "out.b"), (3, "out.c"), (4, "out.a")]


def test_streaming_flow_equals_batch_flow(spark, tmp_path):
    inbox = str(tmp_path / "in")
    flow = parse_flow(
        spec(
            SUBSCRIBE,
            {"script": {"name": "odd", "mode": "filter", "code": "data.n % 2 = 1"}},
            {"log": {"name": "seen"}},
            {"object_store_writer": {"name": "w", "path": "file:///land/{{event.subject}}"}},
            {"log": {"name": "receipts"}},
        )
    )
    rows = spark.range(20).select(
        F.struct(F.col("id").alias("n")).alias("data"), F.concat(F.lit("in."), (F.col("id") % 3).cast("string")).alias("subject"),
        F.col("id").cast("string").alias("id"), F.col("id").alias("timestamp"), F.lit(0).alias("task_id"), F.lit("t").alias("task_type"),
    )
    rows.write.parquet(inbox)

    def landed(root, source, **more):
        result = run_flow(spark, flow, Bindings(inputs={"sub": source}, root=root, **more))
        for query in result.queries.values():
            query.awaitTermination()
        back = read_json_lines(spark, result.written["w"], "n bigint")
        return sorted((r["data"]["n"], r["destination"]) for r in back.collect())

    stream = spark.readStream.schema(rows.schema).parquet(inbox)
    batch = landed(str(tmp_path / "b"), spark.read.parquet(inbox))
    assert len(batch) == 10
    assert landed(str(tmp_path / "s"), stream, checkpoints=str(tmp_path / "cp")) == batch
    with pytest.raises(ValueError, match="checkpoint"):
        landed(str(tmp_path / "x"), stream)


def test_documents_are_written_by_many_tasks(spark):
    from pathlib import Path

    from millrace.plans.sourcequeries import _write_documents

    files = list(Path(_write_documents(spark, "/root/testdata/sf0.01")).rglob("part-*.json"))
    assert len(files) == len({f.parent for f in files}) > 8
    assert len({f.name.split("-")[1] for f in files}) > 4


def test_listing_takes_few_tasks_for_many_folders(spark, tmp_path):
    from millrace.sources.files import file_paths, read_json_docs

    for number in range(120):
        (tmp_path / "in" / f"part={number}").mkdir(parents=True)
        (tmp_path / "in" / f"part={number}" / "a.json").write_text(f'{{"n": {number}}}')
    context, option = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual, tracker = spark.conf.get(option), context.statusTracker()
    context.setJobGroup("listing", "listing")
    try:
        listed, docs = file_paths(spark, str(tmp_path / "in")), read_json_docs(spark, str(tmp_path / "in"))
        stages = [stage for job in tracker.getJobIdsForGroup("listing") for stage in tracker.getJobInfo(job).stageIds]
        assert stages and max(tracker.getStageInfo(stage).numTasks for stage in stages) <= 32
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(option) == usual
    assert listed.count() == 120 and sorted(r["n"] for r in docs.selectExpr("cast(data:n as int) n").collect()) == list(range(120))
