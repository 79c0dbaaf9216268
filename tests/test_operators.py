import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import convert, script
from millrace.operators.convert import batch_to_json, to_json_value, to_record, with_batch_id
from millrace.operators.dedup import _followers, accepted, dedup, mark_duplicates
from millrace.operators.envelope import COLUMNS, event_key, restamp, to_events
from millrace.operators.errors import split_errors
from millrace.operators.iterate import iterate
from millrace.operators.requests import parse_responses, publish_records, render_requests
from millrace.operators.retention import (
    Limits,
    retain,
    retain_age,
    retain_bytes,
    retain_per_subject,
    retain_total,
)
from millrace.operators.sequence import assign_sequence
from millrace.operators.state import last_run_key, state_get, state_history, state_latest, state_put
from millrace.operators.tap import tap
from millrace.sinks.publish import acks, publish
from millrace.sources.messages import advance_cursor, decode_payload, replay_from


def json_events(spark, *texts):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    return rows.select(
        F.try_parse_json("text").alias("data"), F.lit("depot.in").alias("subject"), "id",
        F.lit(7).cast("bigint").alias("timestamp"), F.lit(0).alias("task_id"), F.lit("test").alias("task_type"),
    )


def texts(df):
    return [r["t"] for r in df.select(F.to_json("data").alias("t")).collect()]


# --- envelope ---------------------------------------------------------------


def test_envelope_needs_its_parts(spark):
    df = spark.range(1)
    good = dict(data=F.struct("id"), subject="s", task_type="t")
    for name in ("data", "subject", "task_type"):
        with pytest.raises(ValueError, match=f"Missing required attribute: {name}"):
            to_events(df, **{**good, name: None})
    row = to_events(df, **good, task_id=1).first()
    assert row["id"] is None and row["task_id"] == 1 and row["timestamp"] > 1_600_000_000_000_000
    assert tuple(row.asDict()) == COLUMNS


def test_restamp_and_key(spark):
    events = json_events(spark, "1")
    assert events.select(event_key().alias("k")).first()["k"] == "depot.in.0"
    out = restamp(events, task_id=3, task_type="convert", subject="name", drop_id=True, processed_at=True)
    row = out.first()
    assert (row["subject"], row["id"], row["task_id"], row["timestamp"]) == ("name", None, 3, 7)
    assert row["processed_at"] > row["timestamp"]
    assert out.select(event_key().alias("k")).first()["k"] == "name.7"


# --- script -----------------------------------------------------------------


def test_script_map_keeps_subject_and_id(spark):
    events = json_events(spark, '{"grams":1200}')
    out = script.script_map(events, "named_struct('kilos', variant_get(data, '$.grams', 'int') / 1000, 'checked', 'yes')").first()
    assert (out["subject"], out["id"], out["data"]["kilos"], out["data"]["checked"]) == ("depot.in", "0", 1.2, "yes")


def test_script_filter_drops_null(spark):
    events = json_events(spark, '{"grams":1200}', '{"grams":80}', "{}")
    assert script.script_filter(events, "variant_get(data, '$.grams', 'int') > 500").count() == 1


def test_script_fanout(spark):
    events = json_events(spark, '["north",{"stop":"east"},7.5,null]', "[]", '{"a":1}', "null")
    out = script.script_fanout(events, "data")
    assert texts(out) == ['"north"', '{"stop":"east"}', "7.5", "null"]
    assert {r["subject"] for r in out.collect()} == {"depot.in"}


def test_script_envelope_types(spark):
    events = json_events(
        spark,
        '{"subject":"new","data":{"a":1},"id":"n"}',
        '{"subject":5,"data":[1],"id":6}',
        '{"subject":"only","data":null}',
    )
    out = script.script_envelope(events, "data")
    rows = [(r["subject"], r["id"], r["t"]) for r in out.select("subject", "id", F.to_json("data").alias("t")).collect()]
    assert rows == [("new", "n", '{"a":1}'), ("depot.in", None, "[1]"), ("only", None, "null")]
    with pytest.raises(ValueError):
        script.script_envelope(events, "named_struct('subject', 'x')")


def test_script_envelope_untouched_payload_stays_typed(spark):
    events = json_events(spark, "1").withColumn("data", F.struct(F.lit(1).alias("a")))
    out = script.script_envelope(events, "named_struct('subject', 's2', 'data', data, 'id', 4)")
    assert out.schema["data"] == events.schema["data"]
    assert (out.first()["subject"], out.first()["id"]) == ("s2", None)


# --- convert ----------------------------------------------------------------

PARCEL = {
    "type": "record",
    "name": "Parcel",
    "fields": [
        {"name": "depot", "type": "string", "default": ""},
        {"name": "note", "type": ["null", "string"], "default": None},
        {"name": "parcel_no", "type": "string"},
        {"name": "tags", "type": {"type": "map", "values": "string"}, "default": {}},
        {"name": "sides", "type": {"type": "array", "items": "int"}, "default": [1]},
        {"name": "speed", "type": {"type": "enum", "name": "Speed", "symbols": ["SLOW", "FAST"]}, "default": "SLOW"},
        {"name": "worth", "type": ["null", "long", "string"], "default": None},
        {
            "name": "stop",
            "type": {
                "type": "record",
                "name": "Stop",
                "fields": [{"name": "town", "type": ["null", "string"], "default": None}, {"name": "n", "type": "int", "default": 0}],
            },
            "default": {"town": "none", "n": 3},
        },
    ],
}


def parcel(**fields):
    usual = dict(depot="", note=None, parcel_no="m", tags={}, sides=[1], speed="SLOW", worth=None, stop={"town": "none", "n": 3})
    return usual | fields


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{"parcel-no":"m"}', parcel()),
        (
            '{"parcel_no":"plain","parcel-no":"renamed","depot":"s","note":"c","tags":{"a":"b"},"sides":[],"speed":"FAST","stop":{"n":4},"extra":1}',
            parcel(depot="s", note="c", parcel_no="renamed", tags={"a": "b"}, sides=[], speed="FAST", stop={"town": None, "n": 4}),
        ),
        ('{"parcel_no":"m","note":null}', parcel()),
        ('{"parcel_no":"m","worth":5}', parcel(worth={"long": 5, "string": None})),
        ('{"parcel_no":"m","worth":"much"}', parcel(worth={"long": None, "string": "much"})),
        ('{"parcel_no":"m","worth":null}', parcel()),
        ('{"parcel_no":"m","worth":[5]}', "SchemaMismatch"),
        ('{"depot":"s"}', "SchemaMismatch"),
        ('{"parcel_no":5}', "SchemaMismatch"),
        ('{"parcel_no":"m","depot":null}', "SchemaMismatch"),
        ('{"parcel_no":"m","tags":{"a":1}}', "SchemaMismatch"),
        ('{"parcel_no":"m","tags":[]}', "SchemaMismatch"),
        ('{"parcel_no":"m","sides":["x"]}', "SchemaMismatch"),
        ('{"parcel_no":"m","speed":"MID"}', "SchemaMismatch"),
        ('{"parcel_no":"m","stop":{"n":"x"}}', "SchemaMismatch"),
        ('{"parcel_no":"m","stop":"text"}', "SchemaMismatch"),
        ("[1]", "SchemaMismatch"),
        ("not json", "InvalidJson"),
    ],
)
def test_to_record(spark, text, expected):
    row = to_record(json_events(spark, text), json.dumps(PARCEL)).first()
    if isinstance(expected, str):
        assert row["_error"] == expected and row["data"] is None
    else:
        assert row["_error"] is None
        assert row["data"].asDict(recursive=True) == expected


def test_scalar_schema_and_missing_schema(spark):
    row = to_record(json_events(spark, '"plain words"'), {"type": "string"}).first()
    assert row["data"] == "plain words"
    with pytest.raises(ValueError, match="schema"):
        to_record(json_events(spark, "1"), None)


def test_record_and_json_pass_through(spark):
    events = json_events(spark, '{"a":1}')
    assert to_json_value(events) is events
    record = events.withColumn("data", F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b")))
    assert to_record(record, {"type": "string"}, form="record") is record
    assert texts(to_json_value(record)) == ['{"a":1,"b":null}']


def test_conversion_legality():
    convert.check_conversion("batch", "json")
    convert.check_conversion("record", "record")
    with pytest.raises(ValueError, match="UnsupportedConversion"):
        convert.check_conversion("batch", "record")
    with pytest.raises(ValueError):
        convert.check_conversion("json", "xml")


def test_batches(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, None), (2, 9, "z")], "b int, id int, name string")
    rows = {r["batch_id"]: r["data"] for r in batch_to_json(df, "b", F.struct("id", "name"), order_by="id").collect()}
    assert rows == {1: '[{"id":1,"name":"a"},{"id":2,"name":null},{"id":3,"name":"c"}]', 2: '[{"id":9,"name":"z"}]'}
    chunks = batch_to_json(df, "b", F.struct("id"), order_by="id", chunk_rows=2).collect()
    assert sorted((r["batch_id"], r["chunk"], r["n_rows"], r["data"]) for r in chunks) == [
        (1, 0, 2, '[{"id":1},{"id":2}]'), (1, 1, 1, '[{"id":3}]'), (2, 0, 1, '[{"id":9}]')
    ]


def test_batch_ids_are_bounded(spark):
    df = with_batch_id(spark.range(0, 1000, 1, 3), 100)
    sizes = [r["count"] for r in df.groupBy("batch_id").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1000 and len(sizes) == 12


# --- iterate ----------------------------------------------------------------


def test_iterate_root_and_key(spark):
    good, bad = split_errors(iterate(json_events(spark, '["left",{"turn":90}]', "[]", "[null]"), name="it"))
    assert texts(good) == ['"left"', '{"turn":90}', "null"]
    assert {(r["subject"], r["id"]) for r in good.collect()} == {("it", None)} and bad.count() == 0
    good, bad = split_errors(iterate(json_events(spark, '{"legs":[{"km":4.5},[8],"ferry"],"carrier":"x"}'), "legs"))
    assert texts(good) == ['{"km":4.5}', "[8]", '"ferry"'] and bad.count() == 0


def test_iterate_errors(spark):
    events = json_events(spark, '{"legs":["a"]}', '{"stops":{"a":1}}', '{"stops":null}', "[1]", "5")
    good, bad = split_errors(iterate(events, "stops", name="it"))
    assert good.count() == 0
    assert [(r["id"], r["_error"], r["subject"]) for r in bad.orderBy("id").collect()] == [
        ("0", "KeyNotFound", "depot.in"), ("1", "ExpectedArray", "depot.in"), ("2", "ExpectedArray", "depot.in"),
        ("3", "KeyNotFound", "depot.in"), ("4", "KeyNotFound", "depot.in"),
    ]
    _, bad = split_errors(iterate(json_events(spark, '{"carrier":"x"}')))
    assert [r["_error"] for r in bad.collect()] == ["ExpectedArray"]


def test_iterate_parses_once(spark, tmp_path):
    """Filtering good rows must not evaluate the parse a second time."""
    path = str(tmp_path / "t")
    spark.createDataFrame([("[1]",)], "text string").write.parquet(path)
    events = spark.read.parquet(path).select(
        F.try_parse_json("text").alias("data"), F.lit("s").alias("subject"), F.lit("i").alias("id")
    )
    good, _ = split_errors(iterate(events))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


# --- state ------------------------------------------------------------------


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    rng, expected = random.Random(3), {}
    for start in (0, 50):
        entries = [(f"k{rng.randint(0, 4)}", f"v{i}", i) for i in range(start, start + 50)]
        expected.update({k: v for k, v, _ in entries})
        state_put(spark, path, spark.createDataFrame(entries, "key string, value string, revision bigint"))
    log = spark.read.parquet(path)
    assert {r["key"]: r["value"] for r in state_latest(log).collect()} == expected
    assert state_get(log, "k1") == expected["k1"]
    with pytest.raises(KeyError):
        state_get(log, "absent")
    kept = state_history(log).groupBy("key").agg(F.count("*").alias("n"), F.max("revision").alias("m")).collect()
    assert all(r["n"] == 10 for r in kept)


def test_last_run_key(spark):
    assert spark.range(1).select(last_run_key("test-flow", "test", "test").alias("k")).first()["k"] == "test-flow.test.test.last_run"


def test_replay(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(10).select(F.col("id").alias("sequence")).write.parquet(path)
    messages = spark.read.parquet(path)
    cursors = spark.createDataFrame([("a", 3), ("a", 6), ("b", 1)], "name string, replay_id bigint")
    resumed = replay_from(messages, cursors, "a")
    assert sorted(r["sequence"] for r in resumed.collect()) == [7, 8, 9]
    assert "GreaterThan(sequence,6)" in resumed._jdf.queryExecution().executedPlan().toString()
    assert replay_from(messages, cursors, "new").count() == 10
    assert replay_from(messages, cursors, "a", managed=True).count() == 10
    assert replay_from(messages, cursors, "a", enabled=False).count() == 10
    assert tuple(advance_cursor(messages, "a").first()) == ("a", 9)


# --- dedup ------------------------------------------------------------------


def brute_dedup(rows, window):
    last, out = {}, []
    for id, at, tie in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if id is None or id not in last or at >= last[id] + window:
            last[id] = at
            out.append((id, at, tie))
    return sorted(out, key=str)


def skewed_rows(n=3000, seed=1):
    """One id holds a third of all rows, some of them at the same time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        id = "hot" if i % 3 == 0 else f"id{rng.randint(0, 200)}"
        rows.append((id, rng.randint(0, 400) * 250_000, i))
    return rows + [(None, 5, n), (None, 5, n + 1)]


@pytest.mark.parametrize("ranges", [None, 20])
@pytest.mark.parametrize("window", [1, 700_000, 10_000_000, 10**12])
def test_dedup_against_brute_force(spark, ranges, window):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id string, t bigint, tie bigint")
    kept = [tuple(r) for r in dedup(df, "id", "t", "tie", window, ranges=ranges).collect()]
    assert sorted(kept, key=str) == brute_dedup(rows, window)


def test_dedup_of_few_ids_with_many_rows(spark):
    rows = [(f"id{i % 4}", (i * 7919) % 40_000 * 1_000, i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "id string, t bigint, tie bigint")
    for ranges in (None, 16):
        found = {tuple(r) for r in accepted(df, "id", "t", "tie", 50_000, ranges=ranges).collect()}
        assert found == {(i, t, tie) for i, t, tie in brute_dedup(rows, 50_000)}


def test_dedup_over_ranges_with_gaps_and_dense_times(spark):
    """Ids that span many ranges: windows longer than a range, times a window apart."""
    rng = random.Random(5)
    rows = [("dense", t, t) for t in range(1500)] + [("grid", t * 10, t) for t in range(400)]
    rows += [("gaps", rng.randrange(100) * 10_000 + rng.randrange(50), i) for i in range(800)] + [(f"s{i}", i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, t bigint, tie bigint")
    for window in (1, 10, 37, 900, 20_000):
        kept = [tuple(r) for r in dedup(df, "id", "t", "tie", window, ranges=25).collect()]
        distinct = {}
        for id, t, tie in rows:
            distinct[id, t] = min(tie, distinct.get((id, t), tie))
        assert sorted(kept, key=str) == brute_dedup([(id, t, tie) for (id, t), tie in distinct.items()], window)


def test_followers_of_dense_times_take_linear_frames(spark):
    """A frame up to the end of a partition is computed anew for each of its rows."""
    waiting = spark.createDataFrame([("x", t, 1, t) for t in range(1000, 1300)], "_id string, _ts bigint, _part int, _exit bigint")
    leaving = spark.createDataFrame([("x", t, t) for t in range(0, 1000)], "_id string, _ts bigint, _exit bigint")
    found = _followers(leaving, waiting, 400)
    assert "unboundedfollowing" not in found._jdf.queryExecution().toString().lower()
    assert {tuple(r) for r in found.collect()} == {("x", t, max(t + 400, 1000), 1) for t in range(900)}


def test_dedup_window_is_measured_from_the_accepted_row(spark):
    df = spark.createDataFrame([("x", t, t) for t in (0, 5, 11, 12, 30)], "id string, t bigint, tie bigint")
    marked = mark_duplicates(df, "id", "t", "tie", 10).orderBy("t").collect()
    assert [r["duplicate"] for r in marked] == [False, True, False, True, False]
    assert accepted(df, "id", "t", "tie", 10).count() == 3


# --- retention --------------------------------------------------------------


def messages(spark, n=5000):
    """A third of the messages share one subject; sizes vary; sequences have gaps."""
    return spark.range(n).select(
        (F.col("id") * 37 + 5).alias("sequence"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 17).cast("string"))).alias("subject"),
        (F.col("id") * 1_000_000).alias("timestamp"),
        (F.col("id") * 7919 % 101 + 1).alias("bytes"),
    )


@pytest.mark.parametrize("discard", ["old", "new"])
@pytest.mark.parametrize("limit", [0, 1, 777, 100_000, 10**9])
def test_retain_bytes(spark, limit, discard):
    df = messages(spark).cache()
    rows = sorted(((r["sequence"], r["bytes"]) for r in df.collect()), reverse=discard == "old")
    expected, total = [], 0
    for sequence, size in rows:
        total += size
        if total > limit:
            break
        expected.append(sequence)
    kept = [r["sequence"] for r in retain_bytes(df, limit, discard=discard).collect()]
    assert sorted(kept) == sorted(expected)


@pytest.mark.parametrize("discard", ["old", "new"])
@pytest.mark.parametrize("limit", [0, 1, 3000, 10_000])
def test_retain_total(spark, limit, discard):
    df = messages(spark)
    rows = sorted((r["sequence"] for r in df.collect()), reverse=discard == "old")
    kept = [r["sequence"] for r in retain_total(df, limit, discard=discard).collect()]
    assert sorted(kept) == sorted(rows[:limit])


@pytest.mark.parametrize("discard", ["old", "new"])
@pytest.mark.parametrize("limit", [1, 50, 1200, 5000])
def test_retain_per_subject(spark, limit, discard):
    """1200 is above the rank limit and takes the bucket path."""
    df = messages(spark)
    groups = {}
    for r in sorted(df.collect(), key=lambda r: r["sequence"], reverse=discard == "old"):
        groups.setdefault(r["subject"], []).append(r["sequence"])
    expected = sorted(s for g in groups.values() for s in g[:limit])
    kept = [r["sequence"] for r in retain_per_subject(df, limit, discard=discard).collect()]
    assert sorted(kept) == expected


@pytest.mark.parametrize("held", [10_000, 3])
def test_retain_hot_subject(spark, monkeypatch, held):
    """One subject has nine of ten messages; with few keys held, others are shuffled."""
    from millrace.operators import lookup

    monkeypatch.setattr(lookup, "HELD_ROWS", held)
    rows = [(i * 3 + 1, "hot" if i % 10 else (f"s{i % 70}" if i % 20 else None)) for i in range(4000)]
    df = spark.createDataFrame(rows, "sequence bigint, subject string")
    for discard in ("old", "new"):
        kept = sorted(r["sequence"] for r in retain_per_subject(df, 12, discard=discard).collect())
        expected = []
        for subject in {s for _, s in rows}:
            own = sorted(n for n, s in rows if s == subject)
            expected += own[-12:] if discard == "old" else own[:12]
        assert kept == sorted(expected)
    if held > 100:
        plan = retain_per_subject(df, 12)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_retain_all_limits(spark):
    df = messages(spark)
    limits = Limits(max_age_secs=3000, max_messages_per_subject=1500, max_messages=900, max_bytes=20_000, max_message_size=90)
    kept = retain(df, limits, now=F.lit(5_000_000_000))
    stats = kept.agg(F.count("*"), F.sum("bytes"), F.max("bytes"), F.min("timestamp")).first()
    assert 0 < stats[0] <= 900 and stats[1] <= 20_000 and stats[2] <= 90 and stats[3] >= 2_000_000_000
    assert retain_age(df, 10, now=F.lit(4_999_000_000)).count() == 11
    with pytest.raises(ValueError):
        Limits(discard="both")


# --- sequence and publish ---------------------------------------------------


def test_sequence_is_gap_free_under_ties(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.xxhash64("id") % 1000).cast("bigint").alias("timestamp"),
        F.format_string("%05d", "id").alias("id"),
    )
    out = assign_sequence(df, ["timestamp", "id"], start=10, partitions=16).orderBy("sequence").collect()
    assert [r["sequence"] for r in out] == list(range(10, 9010))
    keys = [(r["timestamp"], r["id"]) for r in out]
    assert keys == sorted(keys)


def test_sequence_skips_flagged_rows(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("t"), (F.col("id") % 4 == 0).alias("skip"))
    out = assign_sequence(df, ["t"], skip="skip", partitions=7).orderBy("t").collect()
    assert len(out) == 3000
    assert [r["sequence"] for r in out if not r["skip"]] == list(range(1, 2251))
    assert all(r["sequence"] is None for r in out if r["skip"])


def test_publish_with_duplicates(spark):
    events = spark.createDataFrame(
        [("a", 0, "x"), ("a", 5, "x"), ("b", 6, "y"), ("a", 20, "z"), (None, 21, "w"), (None, 22, "w")],
        "id string, timestamp bigint, kind string",
    ).select(F.struct("kind").alias("data"), F.lit("s").alias("subject"), "id", "timestamp")
    out = publish(events, "stream", "pub.{{event.data.kind}}", duplicate_window=10)
    rows = out.orderBy("timestamp").select("subject", "sequence", "duplicate").collect()
    assert [tuple(r) for r in rows] == [
        ("pub.x", 1, False), ("pub.x", 1, True), ("pub.y", 2, False), ("pub.z", 3, False), ("pub.w", 4, False), ("pub.w", 5, False)
    ]
    same = spark.createDataFrame([("a", 0, "x")] * 3, "id string, timestamp bigint, kind string").withColumn("subject", F.lit("s"))
    stored = publish(same, "stream", "s", duplicate_window="2m")
    assert sorted((r["sequence"], r["duplicate"]) for r in stored.collect()) == [(1, False), (1, True), (1, True)]
    assert acks(out).columns == ["stream", "sequence", "domain", "duplicate"]


# --- requests, responses, payloads, tap -------------------------------------


def test_request_payload_priority(spark):
    events = json_events(spark, '{"a":"x y","b":1,"n":null}')
    payload = {"from_event": True, "object": {"o": "1"}, "input": "[]", "send_as": "Json"}
    config = {"endpoint": "http://h/{{event.id}}", "method": "PUT", "payload": payload}
    row = render_requests(events, config).first()
    assert (row["method"], row["endpoint"], row["body"]) == ("PUT", "http://h/0", '{"a":"x y","b":1,"n":null}')
    config["payload"] = {"object": {"o": "{{event.id}}", "k": 2}, "input": "[]"}
    assert render_requests(events, config).first()["body"] == '{"o":"0","k":2}'
    config["payload"] = {"input": '{"i":"{{event.subject}}"}'}
    assert render_requests(events, config).first()["body"] == '{"i":"depot.in"}'
    config["payload"] = {"input": "{broken"}
    assert render_requests(events, config).first()["_error"] == "InvalidJson"
    config["payload"] = {}
    with pytest.raises(ValueError):
        render_requests(events, config)
    with pytest.raises(ValueError):
        render_requests(events, {"endpoint": "x", "method": "TRACE"})


def test_form_encoding_of_an_event(spark):
    events = json_events(spark, '{"a":"x y&","b":1,"n":null}', '{"a":[1]}')
    config = {"endpoint": "http://h?q=1", "payload": {"from_event": True, "send_as": "QueryParams"}}
    rows = render_requests(events, config).collect()
    assert rows[0]["endpoint"] == "http://h?q=1&a=x+y%26&b=1" and rows[0]["_error"] is None
    assert rows[1]["_error"] == "UnsupportedConversion"


def test_responses(spark):
    df = spark.createDataFrame([('{"a":1}', 500), ("<html>", 200), ("", 200), ("5", 200)], "body string, status int")
    assert texts(parse_responses(df)) == ['{"a":1}', '"<html>"', '""', "5"]


def test_publish_records_overrides_created_date(spark):
    schema = {"type": "record", "name": "R", "fields": [{"name": "Name", "type": "string"}, {"name": "CreatedDate", "type": "long"}]}
    events = json_events(spark, '{"n":"x"}')
    row = publish_records(events, {"Name": "{{event.data.n}}", "CreatedDate": "no"}, schema, created_ms=F.lit(5)).first()
    assert tuple(row["data"]) == ("x", 5)
    now = publish_records(events, {"Name": "a"}, schema).first()["data"]["CreatedDate"]
    assert now > 1_600_000_000_000


def test_decode_payload(spark):
    df = spark.createDataFrame(
        [(bytearray(b'{"a":1}'), {"Nats-Msg-Id": "7"}), (bytearray(b"\xff\x00"), {}), (bytearray(b"plain"), {}), (bytearray(b"null"), {})],
        "payload binary, headers map<string,string>",
    )
    rows = decode_payload(df).select("id", "payload_kind", "_error").collect()
    assert [tuple(r) for r in rows] == [
        ("7", "json", None), (None, "undecoded", "InvalidJson"), (None, "undecoded", "InvalidJson"), (None, "json", None)
    ]


def test_tap_counts_and_passes(spark):
    events = json_events(spark, "1", "2", "3")
    passed, seen = tap(events, "debug", "watch")
    assert texts(passed) == ["1", "2", "3"]
    assert seen.get["events"] == 3
    with pytest.raises(ValueError):
        tap(events, "loud")
