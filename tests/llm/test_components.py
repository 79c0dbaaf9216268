"""Connected components against a plain union of sets."""

import random

from millrace.llm.components import components


def plain(edges):
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {a: root(a) for a in parent}


def found(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = components(frame).collect()
    out = {r.node: r.component for r in rows}
    assert len(out) == len(rows)
    return out


def test_random_graphs(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)]
    assert found(spark, edges) == plain(edges)


def test_paths_stars_loops_and_nulls(spark):
    path = [(n, n + 1) for n in range(40, 110)]
    star = [(500, 1000 + n) for n in range(200)] + [(1000 + n, 500) for n in range(0, 200, 7)]
    edges = path + star + [(1003, 2), (7, 7), (None, 3), (3, None), (None, None), (60, 61), (60, 61)]
    random.Random(1).shuffle(edges)
    assert found(spark, edges) == plain(edges)


def test_no_edges(spark):
    assert found(spark, []) == {} and found(spark, [(1, 1), (None, 2)]) == {}
