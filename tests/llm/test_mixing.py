"""Mixing: targets by repeated sharing, thresholds by sorting, unusual rows."""

import random
from collections import defaultdict

import pytest

from millrace.llm import catalog, mixing


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, cut at the cap, share the excess again until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_names, left = {n: 0.0 for n in names}, set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_names:
        total = sum(weight[n] for n in open_names)
        for n in open_names:
            target[n] += left * weight[n] / total
        left = 0.0
        for n in sorted(open_names, key=str):
            if target[n] >= cap * sizes[n]:
                left += target[n] - cap * sizes[n]
                target[n] = float(cap * sizes[n])
                open_names.discard(n)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 1, 5, 40, 700, 90_000]) for i in range(draw.randrange(1, 12))} | {None: draw.randrange(50)}
    frame = spark.createDataFrame([(n, s) for n, s in sizes.items()], "source string, size bigint")
    found = {r.source: (r.source_size, r.target) for r in mixing.source_targets(frame).collect()}
    assert {n: s for n, (s, _) in found.items()} == sizes
    for name, target in plain_targets(sizes).items():
        assert found[name][1] == pytest.approx(target, abs=1e-6)


def test_mix_takes_whole_passes_then_the_smallest_hashes(spark):
    draw = random.Random(9)
    docs = [(i, " ".join(["w"] * draw.randrange(1, 30)), draw.choice(["a"] * 9 + ["b", "c", None])) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    sized = frame.select("doc_id", "source", mixing.word_count(frame.text).alias("size"), mixing.row_hash(frame.doc_id, frame.text).alias("hash"))
    rows = sized.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    targets = plain_targets(sizes)
    copies = {r.doc_id: r.copies for r in mixing.with_copies(sized, mixing.thresholds(sized)).collect()}
    for source, target in targets.items():
        own = sorted((r.hash, r.size, r.doc_id) for r in rows if r.source == source)
        passes = int(target // sizes[source])
        left = target - passes * sizes[source]
        for _, size, doc in own:
            # The document at which the budget ends counts if most of it is within.
            assert copies[doc] == passes + (size <= left + 1e-6 or size - left < left)
            left = left - size if size <= left + 1e-6 else 0
        taken = sum(copies[doc] * size for _, size, doc in own)
        assert abs(target - taken) < 15
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    count = defaultdict(int)
    for r in mixed.collect():
        count[r.doc_id] += 1
    assert count == {doc: n for doc, n in copies.items() if n}


def test_unusual_rows(spark):
    rows = [(1, None, None, 5), (2, "", "a", 5), (3, "one two", "a", 5), (3, "one two", "a", 5), (None, "x y\x0bz", "b", None), (4, "w " * 200_000, "b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert [r[0] for r in frame.select(mixing.word_count(frame.text)).collect()] == [0, 0, 2, 2, 2, 200_000]
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    again = mixing.mix(frame.repartition(3))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    three = [r for r in mixed.collect() if r.doc_id == 3]
    assert len(three) % 2 == 0
    assert mixing.mix(frame.limit(0)).count() == 0


def test_query_is_near_every_target(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        rows = catalog.QUERIES["op4_mix_sources"](spark, f"/root/testdata/{sf}").join(docs.select("doc_id", "source", "text"), "doc_id").collect()
        taken, target, largest = defaultdict(int), {}, defaultdict(lambda: defaultdict(int))
        for r in rows:
            taken[r.source] += r.taken
            target[r.source] = r.target
            largest[r.source][r.doc_id, r.text] += r.size
            assert r.taken <= 3 * r.size
        for source, wanted in target.items():
            assert abs(taken[source] - wanted) <= max(largest[source].values()) / 2
