"""Nearest neighbours against brute force: recall, exact scores, ties, unusual rows."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import blocks, catalog, neighbours

SF = "/root/testdata/sf0.1"


def brute(vectors, ids, asked, k):
    """id -> [(id, cosine)] of the k nearest other rows, ties to the smaller id."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for n in asked:
        score = np.round(unit @ unit[n], 12)
        order = [m for m in np.lexsort((ids, -score)) if m != n][:k]
        out[int(ids[n])] = [(int(ids[m]), float(unit[m] @ unit[n])) for m in order]
    return out


def test_query_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    vectors, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    truth = brute(vectors, ids, [n for n, i in enumerate(ids) if i % 50 == 0], 5)
    found = {}
    for r in catalog.QUERIES["op8_nearest_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == truth.keys()
    hits = 0
    for name, answer in found.items():
        assert [r.rank for r in answer] == [1, 2, 3, 4, 5]
        assert all(a.score >= b.score for a, b in zip(answer, answer[1:]))
        for r in answer:
            a, b = vectors[name == ids][0], vectors[r.vec_id == ids][0]
            assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        hits += len({r.vec_id for r in answer} & {i for i, _ in truth[name]})
    assert hits / (5 * len(truth)) >= 0.93


def test_hot_vectors_in_parts(spark, monkeypatch):
    """A third of the rows equal, another third close together, regions cut into parts."""
    monkeypatch.setattr(neighbours, "REGION_ROWS", 50)
    random = np.random.default_rng(4)
    spread, hot = random.normal(size=(300, 8)), random.normal(size=8)
    vectors = np.concatenate([spread, np.repeat(hot[None], 300, axis=0), hot + random.normal(size=(300, 8)) * 0.01])
    ids = random.permutation(len(vectors))
    frame = spark.createDataFrame([(int(i), v.tolist(), 0.5) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, score double")
    truth = brute(vectors, ids, [n for n, i in enumerate(ids) if i % 10 == 0], 5)
    found = {}
    for r in neighbours.nearest(frame.repartition(5), F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    hits = sum(len(set(found[name]) & {i for i, _ in answer}) for name, answer in truth.items())
    assert hits / (5 * len(truth)) >= 0.93
    equal = {int(i) for i in ids[300:600]}
    first = sorted(equal)
    for name in equal & truth.keys():
        assert found[name] == [i for i in first if i != name][:5]


def test_unusual_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (50, []), (100, [0.0, 0.0]), (150, [None, 1.0]), (200, [nan, 1.0]), (250, [inf, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = F.col("vec_id") % 50 == 0
    assert neighbours.nearest(frame, asks).count() == 0
    assert neighbours.nearest(frame.limit(0), asks).count() == 0
    more = spark.createDataFrame([(300, [1.0, 0.0]), (300, [1.0, 0.0]), (1, [2.0]), (None, [-1.0, 0.1])], frame.schema)
    got = neighbours.nearest(frame.union(more), asks).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(300, 1, 1), (300, 1, 1), (300, 2, 300), (300, 2, 300), (300, 3, None), (300, 3, None)]
    assert got[0].score == 1.0 and abs(got[-1].score + 1 / math.sqrt(1.01)) < 1e-15
    one = spark.createDataFrame([(50, [1.0])], frame.schema)
    assert neighbours.nearest(one, asks).count() == 0


def test_fit_holds_a_few_probes_at_once():
    """The driver never holds all probes against the whole sample."""
    points = np.random.default_rng(8).normal(size=(12_000, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tracemalloc.start()
    index = neighbours.Index.fit(points, 1_000_000, 5, 0.98, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(points) * 8 / 4
    near = -np.sort(-(points[:400] @ points.T), axis=1)[:, 5]
    assert abs(index.cosine - np.quantile(near, 0.1)) < 1e-12
    few = neighbours.Index.fit(points[:3], 3, 5, 0.98, 2)
    assert abs(few.cosine - max(0.0, np.quantile((points[:3] @ points[:3].T).min(axis=1), 0.1))) < 1e-12


def test_queries_go_to_regions_with_bits(spark):
    """A query names the buckets that it visits, of any share, in one bit each."""
    points = np.random.default_rng(9).normal(size=(40, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    own = neighbours.Index.fit(points, 100_000, 5, 0.98, 2)
    frame = spark.createDataFrame([(n, n, p.tolist()) for n, p in enumerate(points)], "row long, vec_id long, vector array<double>")
    for everywhere in (False, True):
        found = {}
        for r in neighbours._sent(frame, spark.sparkContext.broadcast(own), 6, everywhere).collect():
            assert len(r.visits) == math.ceil(own.region_size / 8) and r.vector == points[r.row].tolist()
            t, region = divmod(r.place, neighbours.SLOTS**neighbours.REGION_FUNCTIONS)
            bits = np.flatnonzero(np.unpackbits(np.frombuffer(r.visits, np.uint8)))
            found.setdefault((r.row, t), []).extend((region * own.region_size + bits).tolist())
        for n, point in enumerate(points):
            for t in range(2):
                assert sorted(found[n, t]) == sorted(own.visits(point, t, 1.0 if everywhere else own.share).tolist())


def test_rows_beside_groups_in_slices(spark):
    """A group of any number of queries is met by a few of them at a time."""
    rows = [(key, False, n) for key in (1, 2) for n in range(30)] + [(key, True, n) for key in (1, 3) for n in range(5_000)]
    frame = spark.createDataFrame(rows, "key int, asks boolean, n long").repartition(4)

    def work(ready, asking):
        yield pa.record_batch([[len(ready)], [asking.num_rows], [sum(asking.column("n").to_pylist())], [asking.column("key")[0].as_py()]], ["held", "asked", "total", "key"])

    prepare = lambda held: held["n"].to_pylist()
    got = blocks.map_beside_groups(frame, ["key"], "asks", 64, prepare, work, "held long, asked long, total long, key long").collect()
    assert {(r.key, r.held) for r in got} == {(1, 30)}
    assert max(r.asked for r in got) <= 64
    assert sum(r.asked for r in got) == 5_000 and sum(r.total for r in got) == sum(range(5_000))


def test_slices_change_no_result(spark, monkeypatch):
    random = np.random.default_rng(10)
    vectors = np.concatenate([random.normal(size=(400, 5)), np.repeat(random.normal(size=(1, 5)), 40, axis=0)])
    rows = [(n if n % 7 else None, v.tolist()) for n, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    answers = lambda: sorted(map(tuple, neighbours.nearest(frame, F.col("vec_id") % 2 == 0).collect()), key=repr)
    whole = answers()
    for name, value in (("AT_ONCE", 3), ("PROBES_AT_ONCE", 7), ("REGION_ROWS", 40)):
        monkeypatch.setattr(neighbours, name, value)
    assert answers() == whole
