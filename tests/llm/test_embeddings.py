"""Near copies among embeddings against brute force."""

import math

import numpy as np
import pytest

from millrace.llm import embeddings


def brute(rows, threshold=0.95):
    """vec_id -> (n_links, component, kept) by all pairs."""
    valid = {}
    for n, (_, v, *_rest) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            scaled = np.array(v, float) / max(map(abs, v))
            valid[n] = scaled / np.linalg.norm(scaled)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in valid:
        for b in valid:
            if a < b and valid[a] @ valid[b] >= threshold:
                links[a] += 1
                links[b] += 1
                parent[root(b)] = root(a)
    least = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            least[root(n)] = min(least.get(root(n), row[0]), row[0])
    return sorted((str(row[0]), links[n], least.get(root(n)), row[0] is not None and row[0] == least.get(root(n))) for n, row in enumerate(rows))


def got(frame):
    return sorted((str(r.vec_id), r.n_links, r.component, r.kept) for r in frame.collect())


@pytest.mark.parametrize("width", [3, 12])
def test_against_brute_force_in_many_cells_and_blocks(spark, monkeypatch, width):
    monkeypatch.setattr(embeddings, "CLASSES_PER_CELL", 40)
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    random = np.random.default_rng(width)
    points = random.normal(size=(400, width))
    near = points[:60] + random.normal(size=(60, width)) * 0.2
    hot = points[7] + random.normal(size=(200, width)) * 0.05
    copies = np.repeat(points[9:10], 90, axis=0)
    every = np.concatenate([points, near, hot, copies, points[20:25] * 3])
    rows = [(int(n), [float(x) for x in v], 1) for n, v in enumerate(random.permutation(every))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(7)
    assert got(embeddings.near_copies(frame)) == brute(rows)


def test_unusual_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]),
        (9, [5e300, 0.0]), (10, [1.0]), (11, [-0.0, 2.0]), (12, [0.0, 2.0]), (None, [0.0, 3.0]), (13, [-1.0, 0.0]), (7, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(embeddings.near_copies(frame))
    expected = brute([(i, (v + [0.0] if v and len(v) == 1 else v)) for i, v in rows])
    assert found == expected
    assert embeddings.near_copies(frame.limit(0)).count() == 0
    assert got(embeddings.near_copies(frame.where("vec_id < 7"))) == [(str(n), 0, n, True) for n in range(1, 7)]


def test_no_link_is_lost_at_cell_borders():
    """The rule sends one of every linked pair to the other's cell."""
    random = np.random.default_rng(2)
    centres = embeddings.directions(random.normal(size=(20, 6)))
    cells = embeddings.Cells(centres, 0.95)
    points = embeddings.directions(random.normal(size=(3000, 6)))
    home, visited = cells.visits(points)
    a, b = np.nonzero(np.triu(points @ points.T >= 0.95, 1))
    assert len(a) > 1000 and (home[a] != home[b]).any()
    assert (visited[a, home[b]] | visited[b, home[a]]).all()
