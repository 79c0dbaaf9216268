import time

import pytest
from pyspark.sql import functions as F

from millrace.operators.errors import INVALID_JSON, mark
from millrace.streaming.streams import (
    counted,
    dedup_stream,
    durable_subscription,
    emitted,
    for_each_batch,
    land_split,
    land_stream,
    message_stream,
)

SCHEMA = "subject string, n bigint, at timestamp"


def add_file(spark, folder, rows):
    df = spark.createDataFrame(rows, "subject string, n bigint, s bigint").select(
        "subject", "n", F.timestamp_seconds("s").alias("at")
    )
    df.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return message_stream(spark, str(folder), schema, **options)


def test_durable_subscription_resumes_and_keeps_its_filter(spark, tmp_path):
    inbox, root, out = tmp_path / "in", str(tmp_path / "durable"), str(tmp_path / "out")

    def drain(pattern="a.>"):
        mine, checkpoint = durable_subscription(stream(spark, inbox), pattern, "reader", root)
        land_stream(mine, out, checkpoint).awaitTermination()
        return sorted(r["n"] for r in spark.read.parquet(out).collect())

    add_file(spark, inbox, [("a.x", 1, 0), ("b.x", 2, 0)])
    assert drain() == [1]
    add_file(spark, inbox, [("a.y", 3, 0), ("a", 4, 0)])
    assert drain() == [1, 3]
    assert drain() == [1, 3]
    with pytest.raises(ValueError, match="bound to"):
        drain("b.>")


def test_fetch_size_bounds_each_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    for i in range(3):
        add_file(spark, inbox, [("a.x", i, 0)])
    query = land_stream(
        counted(stream(spark, inbox, max_files=1), "fetch"), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    query.awaitTermination()
    sizes = [p.observedMetrics["fetch"]["events"] for p in query.recentProgress if p.numInputRows]
    assert sizes == [1, 1, 1]
    assert emitted(query, "fetch") == 3


def test_delete_after_read_removes_exactly_what_was_read(spark, tmp_path):
    inbox = tmp_path / "in"

    def drain():
        land_stream(
            stream(spark, inbox, delete_after_read=True), str(tmp_path / "out"), str(tmp_path / "cp")
        ).awaitTermination()

    add_file(spark, inbox, [("a", 1, 0)])
    first = set(inbox.glob("*.parquet"))
    drain()
    add_file(spark, inbox, [("a", 2, 0)])
    second = set(inbox.glob("*.parquet")) - first
    drain()
    # The file of the first batch goes once the second has committed.
    for _ in range(50):
        if not any(p.exists() for p in first):
            break
        time.sleep(0.1)
    assert not any(p.exists() for p in first) and all(p.exists() for p in second)
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_dedup_stream_across_batches(spark, tmp_path):
    inbox = tmp_path / "in"

    def drain():
        once = dedup_stream(stream(spark, inbox), "subject", "at", "10s")
        land_stream(once, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    add_file(spark, inbox, [("a", 1, 100), ("b", 2, 100)])
    drain()
    add_file(spark, inbox, [("a", 3, 105), ("c", 4, 106)])
    drain()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["subject"] for r in rows.collect()) == ["a", "b", "c"]
    # State expires: far beyond the window the id is accepted again.
    add_file(spark, inbox, [("z", 5, 500)])
    drain()
    add_file(spark, inbox, [("a", 6, 501)])
    drain()
    assert sorted(r["subject"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "a", "b", "c", "z"]


def test_dedup_stream_of_many_ids_takes_few_groups(spark, tmp_path):
    """Thousands of ids in a few states, over batches, against the walk of each id."""
    rows = [(f"id{i * 31 % 2000}", i, 1000 + i * 7919 % 600) for i in range(6000)]
    for part in range(3):
        add_file(spark, tmp_path / "in", [r for r in rows if (r[2] - 1000) // 200 == part])
        once = dedup_stream(stream(spark, tmp_path / "in"), "subject", "at", "100s", tie="n", buckets=3)
        query = land_stream(once, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    last, expected = {}, set()
    for subject, n, at in sorted(rows, key=lambda r: (r[2], r[1])):
        if subject not in last or at >= last[subject] + 100:
            last[subject] = at
            expected.add((subject, n))
    found = [(r["subject"], r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(found) == sorted(expected)
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) <= 3


@pytest.mark.parametrize("id", ["cast(n % 7 as double) * 0", "struct(n % 7 as a, subject as b)", "cast(subject as binary)", "array(n % 5)"])
def test_dedup_stream_by_ids_of_other_types(spark, tmp_path, id):
    rows = [(f"id{i % 11}", i - 50, 100) for i in range(100)]
    add_file(spark, tmp_path / "in", rows)
    once = dedup_stream(stream(spark, tmp_path / "in").withColumn("id", F.expr(id)), "id", "at", "10s", tie="n", buckets=2)
    land_stream(once, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    firsts = spark.createDataFrame(rows, "subject string, n bigint, at bigint").groupBy(F.expr(id).alias("id")).agg(F.min("n").alias("n"))
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(r["n"] for r in firsts.collect())


def test_stream_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    add_file(spark, inbox, [("a", i, i * 86_400) for i in range(20)])
    shape = lambda df: df.where("n % 3 = 0").select("n", F.dayofmonth("at").alias("day"))
    land_stream(
        shape(stream(spark, inbox)), str(tmp_path / "out"), str(tmp_path / "cp"), partition_by=["day"]
    ).awaitTermination()
    landed = sorted((r["n"], r["day"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert landed == sorted(tuple(r) for r in shape(spark.read.parquet(str(inbox))).collect())


def test_split_and_batch_sink(spark, tmp_path):
    inbox = tmp_path / "in"
    add_file(spark, inbox, [("a", i, 0) for i in range(6)])
    marked = mark(stream(spark, inbox), F.when(F.col("n") % 2 == 1, F.lit(INVALID_JSON)))
    land_split(marked, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "good")).collect()) == [0, 2, 4]
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [1, 3, 5]
    sizes = []
    for_each_batch(
        stream(spark, inbox), lambda batch, _: sizes.append(batch.count()), str(tmp_path / "cp2")
    ).awaitTermination()
    assert sizes == [6]
