"""Vector codes against Lloyd's rounds in plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm import catalog, codes


def plain(vectors, parts, entries, rounds, scale=4096):
    """Codes, errors and final entries of lists of numbers, in their order."""
    q = [[math.floor(scale * x) for x in v] for v in vectors]
    width = len(q[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in q]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((distance(v[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        near = assigned()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [v[p] for v, n in zip(cut, near) if n[p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    near = assigned()
    return [[n[1] for n in row] for row in near], [sum(n[0] for n in row) for row in near], books


@pytest.fixture(scope="module")
def vectors():
    draw = random.Random(11)
    centres = [[draw.uniform(-1, 1) for _ in range(12)] for _ in range(9)]
    return [[round(x + draw.gauss(0, 0.2), 2) for x in draw.choice(centres)] for _ in range(400)]


@pytest.mark.parametrize("rounds", [0, 1, 6, 60])
def test_against_plain_rounds(spark, vectors, rounds):
    frame = spark.createDataFrame([(i, v, "kept") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, code string").repartition(5)
    found, books = codes.compress(frame, parts=4, entries=7, rounds=rounds)
    index, errors, expected = plain(vectors, 4, 7, rounds)
    rows = sorted(found.collect())
    assert [list(r.entry) for r in rows] == index and [r.error for r in rows] == errors
    assert [r.code for r in rows] == ["".join(f"{e:02x}" for e in own) for own in index]
    assert books.entries.tolist() == expected
    joined = ",".join(str(x) for part in expected for entry in part for x in entry)
    assert books.sha256() == hashlib.sha256(joined.encode()).hexdigest()


def test_fixed_parts_compare_moved_entries_only(monkeypatch):
    draw = np.random.default_rng(3)
    q, entries = draw.integers(-50, 50, (300, 8)), draw.integers(-50, 50, (2, 6, 4))
    index, best = codes.assign(q, entries, None, None, None)
    moved = np.zeros((2, 6), bool)
    moved[0, 2] = moved[1, 5] = True
    later = entries.copy()
    later[moved] += draw.integers(-30, 30, (2, 4))
    compared = 0
    whole = codes.distances

    def counted(part, entry):
        nonlocal compared
        compared += len(part)
        return whole(part, entry)

    monkeypatch.setattr(codes, "distances", counted)
    again = codes.assign(q, later, moved, index, best)
    expected = codes.assign(q, later, None, None, None)
    assert (again[0] == expected[0]).all() and (again[1] == expected[1]).all()
    rescanned = int((index[:, 0] == 2).sum() + (index[:, 1] == 5).sum())
    assert compared - 2 * 300 * 6 == rescanned * 6 + (600 - rescanned)


def test_ties_take_the_lower_index():
    entries = np.array([[[4], [0], [2], [0]]])
    index, best = codes.assign(np.array([[1], [3], [0]]), entries, None, None, None)
    assert index.tolist() == [[1], [0], [1]] and best.tolist() == [[1], [1], [0]]
    # An entry that moves to the same distance wins only below the assigned one.
    moved = np.array([[True, False, False, False]])
    entries = np.array([[[2], [0], [2], [0]]])
    index, best = codes.assign(np.array([[1], [3], [0]]), entries, moved, index, best)
    assert index.tolist() == [[0], [0], [1]] and best.tolist() == [[1], [1], [0]]


def test_unusual_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, "a"), (2, [1.0, None], "a"), (3, [nan, 1.0], "a"), (4, [inf, 1.0], None), (None, [0.0, 0.0], None),
        (5, [0.25, -0.25], "b"), (5, [0.25, -0.25], "b"), (6, [], "b"), (7, [0.5], None), (8, [1e300, -1e300], "c"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, `entry` string")
    found, books = codes.compress(frame, parts=2, entries=16)
    got = sorted(((r.vec_id, r.error) for r in found.collect()), key=repr)
    assert got == sorted([(None, 0), (5, 0), (5, 0), (6, 0), (7, 0), (8, 0)], key=repr)
    assert books.entries.shape == (2, 6, 1)
    nothing, books = codes.compress(frame.limit(0), parts=2)
    assert nothing.count() == 0 and books.entries.size == 0
    assert "embedding" not in found.columns and set(found.columns) == {"vec_id", "entry", "distance", "code", "error"}


def test_group_sums(spark, monkeypatch):
    rows = [(i, None if i % 3 == 0 else f"k{min(i, 40)}", i) for i in range(90)]
    frame = spark.createDataFrame(rows, "i long, key string, value long")
    expected = {}
    for _, key, value in rows:
        expected[key] = expected.get(key, 0) + value
    for few in (10_000, 4):
        monkeypatch.setattr(codes, "FEW", few)
        found = codes.with_group_sums(frame, "key", "value", "total").collect()
        assert sorted((r.i, r.total) for r in found) == [(i, expected[key]) for i, key, _ in rows]


def test_query_is_repeatable(spark):
    query = catalog.QUERIES["op12_vector_codes"]
    assert sorted(query(spark, "/root/testdata/sf0.001").collect()) == sorted(query(spark, "/root/testdata/sf0.001").collect())
