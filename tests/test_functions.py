import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import payload as P
from millrace.functions.auth import Credentials
from millrace.functions.cron import parse_cron
from millrace.functions.durations import duration_micros, duration_seconds
from millrace.functions.records import parse_schema
from millrace.functions.subjects import path_subject, publish_subject, source_subject, subject_matches
from millrace.functions.template import render, render_tree
from millrace.sources.requests import ingest_requests
from millrace.sources.schedule import check_schedule, cron_schedule, interval_schedule


def one(spark, column, **literals):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()] or [F.lit(1).alias("_")])
    return row.select(column.alias("out")).first()["out"]


# --- durations and schedules ------------------------------------------------


@pytest.mark.parametrize(
    "text,micros", [("100ms", 100_000), ("30s", 30_000_000), ("5m", 300_000_000), ("1h 30m", 5_400_000_000), ("2days", 172_800_000_000)]
)
def test_durations(text, micros):
    assert duration_micros(text) == micros


@pytest.mark.parametrize("text", ["", "5", "5x", "m5", "5m!"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        duration_micros(text)


def test_schedule_below_one_second_is_refused():
    with pytest.raises(ValueError):
        duration_seconds("100ms")


def test_exactly_one_schedule_kind():
    check_schedule("5m", None)
    check_schedule(None, "* * * * *")
    with pytest.raises(ValueError, match="needs an interval"):
        check_schedule(None, None)
    with pytest.raises(ValueError, match="not both"):
        check_schedule("5m", "* * * * *")


def test_interval_count(spark):
    rows = [tuple(r) for r in interval_schedule(spark, 1000, "1m", count=3).orderBy("run").collect()]
    assert rows == [(0, 1000, None, 1060), (1, 1060, 1000, 1120), (2, 1120, 1060, None)]


def test_interval_single_run_has_no_neighbours(spark):
    row = interval_schedule(spark, 5, "1m", count=1).first()
    assert row["last_run_time"] is None and row["next_run_time"] is None


def test_cron_fields():
    cron = parse_cron("*/20 9-11,22 1,15 JAN-MAR MON-FRI")
    assert cron.minutes == (0, 20, 40)
    assert cron.hours == (9, 10, 11, 22)
    assert cron.days == (1, 15) and cron.months == (1, 2, 3)
    assert cron.weekdays == (1, 2, 3, 4, 5)
    assert parse_cron("0 0 * * 7").weekdays == (0,)
    for bad in ("* * * *", "60 * * * *", "* * * * FOO", "*/0 * * * *", "5-1 * * * *"):
        with pytest.raises(ValueError):
            parse_cron(bad)


def brute_cron(expression, start, end):
    import datetime

    cron, out = parse_cron(expression), []
    for minute in range(start // 60, end // 60 + 1):
        at = datetime.datetime.fromtimestamp(minute * 60, datetime.UTC)
        dom, dow = at.day in cron.days, (at.weekday() + 1) % 7 in cron.weekdays
        if cron.any_day or cron.any_weekday:
            day_ok = dom and dow
        else:
            day_ok = dom or dow
        if at.minute in cron.minutes and at.hour in cron.hours and at.month in cron.months and day_ok:
            if start < minute * 60 <= end:
                out.append(minute * 60)
    return out


@pytest.mark.parametrize("expression", ["0 0 * * *", "*/45 6 * * SUN", "30 12 13 * FRI", "0 9-17 1-7 FEB *"])
def test_cron_against_every_minute(spark, expression):
    start, end = 1_704_067_207, 1_704_067_207 + 70 * 86_400
    rows = cron_schedule(spark, expression, start, end=end).orderBy("scheduled_at").collect()
    expected = brute_cron(expression, start, end + 400 * 86_400)
    inside = [t for t in expected if t <= end]
    assert [r["scheduled_at"] for r in rows] == inside
    assert [r["last_run_time"] for r in rows] == [None, *inside][: len(inside)]
    assert [r["next_run_time"] for r in rows] == expected[1 : len(inside) + 1]


def test_cron_fires_strictly_after_start(spark):
    midnight = 1_704_067_200
    row = cron_schedule(spark, "0 0 * * *", midnight, count=1).first()
    assert row["scheduled_at"] == midnight + 86_400
    assert row["next_run_time"] is None


def test_leap_day_is_found(spark):
    rows = cron_schedule(spark, "0 0 29 FEB *", 1_704_067_200, count=2).orderBy("scheduled_at").collect()
    assert [r["scheduled_at"] for r in rows] == [1_709_164_800, 1_835_395_200]


# --- subjects ---------------------------------------------------------------


@pytest.mark.parametrize(
    "topic,incoming,outgoing",
    [
        ("/data/AccountChangeEvent", "accountchangeevent", "data.accountchangeevent"),
        ("/event/Order__e", "order__e", "event.order__e"),
        ("Plain/Topic", "plain/topic", "Plain/Topic"),
        ("/data/event/X", "event/x", "data.event.x"),
        ("//Odd", "//odd", ".odd"),
        (".Dotted", ".dotted", "dotted"),
    ],
)
def test_topic_subjects(spark, topic, incoming, outgoing):
    assert one(spark, source_subject(F.col("t")), t=topic) == incoming
    assert one(spark, publish_subject(F.col("t")), t=topic) == outgoing


@pytest.mark.parametrize(
    "subject,expected",
    [
        ("pubsub.data.account", "data/account"),
        ("pubsub.event.a.b", "event/a"),
        ("pubsub.data", "pubsub.data"),
        ("pubsub.other.x", "pubsub.other.x"),
        ("x.data.y", "x.data.y"),
    ],
)
def test_path_subject(spark, subject, expected):
    assert one(spark, path_subject(F.col("s")), s=subject) == expected


@pytest.mark.parametrize(
    "pattern,yes,no",
    [
        ("email.>", ["email.a", "email.a.b"], ["email", "email.", "mail.a", "xemail.a"]),
        ("email.*", ["email.a"], ["email.a.b", "email"]),
        ("*.b.>", ["a.b.c", "a.b.c.d"], ["a.b", "b.c"]),
        ("a+.x", ["a+.x"], ["aa.x"]),
        (">", ["a", "a.b"], []),
    ],
)
def test_subject_patterns(spark, pattern, yes, no):
    rows = spark.createDataFrame([(s,) for s in yes + no], "subject string")
    kept = {r["subject"] for r in rows.where(subject_matches(F.col("subject"), pattern)).collect()}
    assert kept == set(yes)


def test_bad_patterns():
    for bad in ("a.>.b", "a..b", ""):
        with pytest.raises(ValueError):
            subject_matches(F.col("s"), bad)


def test_prefix_pattern_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("a.b",), ("c.d",)], "subject string").write.parquet(str(tmp_path / "m"))
    df = spark.read.parquet(str(tmp_path / "m")).where(subject_matches(F.col("subject"), "a.>"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(subject,a.)" in plan


# --- templates --------------------------------------------------------------


def brute_render(template, event):
    """What the template language does with plain paths, in a few lines."""

    def value(match):
        at = {"event": event}
        for part in match.group(1).strip().split("."):
            at = at.get(part) if isinstance(at, dict) else None
        return "" if at is None else str(at)

    return re.sub(r"\{\{([^{}]+)\}\}", value, template)


def test_templates_against_brute_force(spark):
    rng = random.Random(7)
    paths = ["event.subject", "event.id", "event.timestamp", "event.data.a", "event.data.b.c", "event.data.nope", "other.x", "event.data.b.nope", "event.nope"]
    pieces = ["", "/", " & <b>", "-", "é", "x y"]
    templates = [
        "".join(rng.choice(pieces) + "{{" + rng.choice(["", " "]) + rng.choice(paths) + "}}" for _ in range(rng.randint(1, 4)))
        + rng.choice(pieces)
        for _ in range(40)
    ]
    events = [
        {"subject": "s.1", "id": None, "timestamp": 12, "data": {"a": "va", "b": {"c": 5}}},
        {"subject": "s.2", "id": "i2", "timestamp": 13, "data": {"a": None, "b": {"c": None}}},
    ]
    df = spark.createDataFrame(
        [(e["subject"], e["id"], e["timestamp"], (e["data"]["a"], (e["data"]["b"]["c"],))) for e in events],
        "subject string, id string, timestamp bigint, data struct<a:string,b:struct<c:bigint>>",
    )
    rows = df.orderBy("timestamp").select(*[render(t, df).alias(f"t{i}") for i, t in enumerate(templates)]).collect()
    for event, row in zip(events, rows):
        assert list(row) == [brute_render(t, event) for t in templates]


def test_template_over_variant_and_map(spark):
    df = spark.range(1).select(
        F.parse_json(F.lit('{"u":{"first-name":"Jane"},"n":1,"l":[7,8]}')).alias("data"), F.lit("s").alias("subject")
    )
    text = render("{{event.data.u.first-name}}/{{event.data.n}}/{{event.data.l.[1]}}/{{event.data.no.x}}", df)
    assert df.select(text.alias("t")).first()["t"] == "Jane/1/8/"
    mapped = spark.range(1).select(F.create_map(F.lit("k"), F.lit("v")).alias("data"))
    assert mapped.select(render("{{event.data.k}}{{event.data.x}}", mapped).alias("t")).first()["t"] == "v"


def test_template_nesting_and_types(spark):
    df = spark.range(1).select(F.struct(F.lit("john").alias("name")).alias("data"))
    tree = render_tree({"name": "{{event.data.name}}", "value": 42, "tags": ["{{event.data.name}}", "x"], "{{k}}": True}, df)
    row = df.select(tree.alias("t")).first()["t"].asDict(recursive=True)
    assert row == {"name": "john", "value": 42, "tags": ["john", "x"], "{{k}}": True}


def test_templates_with_helpers_are_refused(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x")).alias("data"))
    for bad in ("{{#if event.data.x}}y{{/if}}", "{{event.data.x"):
        with pytest.raises(ValueError):
            render(bad, df)


# --- payloads ---------------------------------------------------------------


@pytest.mark.parametrize(
    "before,after",
    [
        ('{"gross-weight":9,"depot":"n","legs":{"toll-road":true}}', '{"depot":"n","gross_weight":9,"legs":{"toll-road":true}}'),
        ('{"a-b":1,"a_b":2}', '{"a_b":1}'),
        ('{"a-b_c":1,"a_b-c":2}', '{"a_b_c":2}'),
        ('{"a-b_c":1,"a_b-c":2,"a_b_c":3,"z":4}', '{"a_b_c":2,"z":4}'),
        ('{"x":null,"y-z":null}', '{"x":null,"y_z":null}'),
        ("[1,2]", "[1,2]"),
        ('"a-b"', '"a-b"'),
        ("{}", "{}"),
    ],
)
def test_normalize_keys(spark, before, after):
    df = spark.range(1).select(F.parse_json(F.lit(before)).alias("v"))
    assert P.with_normalized_keys(df, "n", "v").select(F.to_json("n").alias("t")).first()["t"] == after


@pytest.mark.parametrize(
    "stored,seen", [('"{\\"a\\":1}"', '{"a":1}'), ('"text"', '"text"'), ('{"a":"{}"}', '{"a":"{}"}'), ("5", "5"), ('"5"', "5")]
)
def test_reparse_string(spark, stored, seen):
    df = spark.range(1).select(F.parse_json(F.lit(stored)).alias("v"))
    assert P.with_reparsed(df, "s", "v").select(F.to_json("s").alias("t")).first()["t"] == seen


@pytest.mark.parametrize(
    "text,parsed",
    [
        ('{"a":1}', '{"a":1}'), (" 5 ", "5"), ("null", "null"), ('{"a":1,"a":2}', '{"a":2}'),
        ("5 apples", None), ('{"a":1} x', None), ("1,2", None), ("1],[2", None), ('"name": "x",', None),
        ("", None), ("  ", None), ("{", None), (None, None),
    ],
)
def test_only_whole_json_counts(spark, text, parsed):
    df = spark.createDataFrame([(text,)], "t string")
    assert P.with_json(df, "v", F.col("t")).select(F.to_json("v").alias("o")).first()["o"] == parsed


def test_bad_schemas():
    for bad in ("{", {"type": "record"}, "strange", ["null", "odd"], {"type": "record", "fields": [{"name": "a", "type": "x"}]}):
        with pytest.raises((ValueError, KeyError)):
            parse_schema(bad)


# --- request authentication -------------------------------------------------

BOTH = Credentials(bearer="t1", username="u", password="p:w")
BASIC = Credentials(username="u", password="p:w")
AUTH_CASES = [
    (None, None, None),
    (BOTH, None, "NoCredentials"),
    (BOTH, "Bearer té", "MalformedCredentials"),
    (BOTH, "Bearer t1", None),
    (BOTH, "Bearer t2", "InvalidCredentials"),
    (BASIC, "Bearer t1", "InvalidCredentials"),
    (BOTH, "Basic ***", "MalformedCredentials"),
    (BOTH, "Basic dTpwOnc", "MalformedCredentials"),  # padding missing
    (BOTH, "Basic dTpwOnd=", "MalformedCredentials"),  # stray bits before the padding
    (BOTH, "Basic //4=", "MalformedCredentials"),  # not UTF-8
    (BOTH, "Basic dTpwOnc=", None),
    (BOTH, "Basic dTp3cm9uZw==", "InvalidCredentials"),
    (BOTH, "bearer t1", "InvalidCredentials"),
    (Credentials(), "Bearer t1", "InvalidCredentials"),
]


@pytest.mark.parametrize("credentials,header,expected", AUTH_CASES)
def test_authentication(spark, credentials, header, expected):
    headers = {"accept": "*/*"} if header is None else {"Authorization": header}
    rows = spark.createDataFrame([(headers, "{")], "headers map<string,string>, body string")
    out = ingest_requests(rows, credentials=credentials).first()
    assert out["auth_error"] == expected
    # Authentication is judged before the (broken) body.
    assert out["status"] == (400 if expected is None else 401)


def test_request_bodies_and_headers(spark):
    rows = spark.createDataFrame(
        [({"X-A": "1", "b": "2"}, ""), ({"x-a": "1"}, None), ({}, '{"k":1}'), ({}, "nope")],
        "headers map<string,string>, body string",
    )
    out = ingest_requests(rows, allow_headers=["x-a"]).select(
        "status", "data.headers", F.to_json("data.payload").alias("payload")
    )
    assert [tuple(r) for r in out.collect()] == [
        (200, {"x-a": "1"}, "null"), (200, {"x-a": "1"}, "null"), (200, {}, '{"k":1}'), (400, None, None)
    ]
