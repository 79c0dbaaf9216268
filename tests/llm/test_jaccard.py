"""The n-gram Jaccard join against all pairs, with hot groups; keeping one of each group."""

import random
from collections import defaultdict

import pytest

from millrace.llm import jaccard


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, threshold=0.8):
    """Per row (id, links, component, kept), by all pairs; one row of a component is kept."""
    sets = [shingles(r[1]) for r in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for n, row in enumerate(rows):
        least[root(n)].append((row[0] is None, row[0] or 0))
    return sorted((str(r[0]), links[n], None if min(least[root(n)])[0] else min(least[root(n)])[1]) for n, r in enumerate(rows))


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghijk", k=6)) for _ in range(4000)]
    text = lambda n: draw.choices(words, k=n)
    rows = [text(draw.randrange(1, 120)) for _ in range(150)]
    hot, shared = text(90), text(60)
    rows += [list(hot) for _ in range(120)]
    for _ in range(150):  # near copies: up to three words changed, or some cut off
        own = list(hot)
        for _ in range(draw.randrange(4)):
            own[draw.randrange(len(own))] = draw.choice(words)
        rows.append(own[: draw.randrange(75, 91)])
    rows += [shared + text(draw.randrange(20, 80)) for _ in range(60)]  # a passage, not a copy
    rows += [["one"], ["One"], ["two", "words"]]
    rows = [" ".join(r) for r in rows] + ["", None, " \n "]
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_join_against_all_pairs(spark, planted):
    settings = jaccard.JoinSettings(bucket=16)  # hot buckets are split, then cut into blocks
    frame = spark.createDataFrame([(i, t, "x") for i, t in planted], "doc_id long, text string, sid string").repartition(6)
    rows = jaccard.join_texts(frame, settings=settings).rows.collect()
    assert sorted((str(r.doc_id), r.n_links, r.component) for r in rows) == brute(planted)
    assert all(r.kept == (r.doc_id == r.component) for r in rows)


def test_runs_reach_the_recall():
    settings = jaccard.JoinSettings()
    assert (1 - settings.meeting(settings.depth)) ** settings.runs <= 1 - settings.recall
    assert settings.meeting(1) == pytest.approx(0.75 * 0.8 + 0.25 * 0.96)


def test_keep_one(spark, planted):
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(planted)], "doc_id long, text string, row long").repartition(3)
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    expected = {int(i) for i, _, c in brute(planted) if int(i) == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    assert {r.doc_id: r.row for r in kept.collect()} == {i: i for i in expected}


def test_unusual_rows(spark):
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words here"), (2, None), (3, ""), (3, ""), (None, long), (None, long), (9, long + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.join_texts(frame).rows.collect()
    assert sorted((str(r.doc_id), r.n_links, r.component) for r in found) == brute(rows)
    kept = sorted((str(r.doc_id), r.text or "") for r in jaccard.keep_one(frame).collect())
    assert kept == sorted([("1", "a b c d e f"), ("1", "other words here"), ("2", ""), ("3", ""), ("3", ""), ("9", long + " end")])
    assert jaccard.keep_one(frame.limit(0)).count() == 0
