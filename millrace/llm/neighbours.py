"""Nearest neighbours by cosine with multiprobe p-stable hashing.

A table of the index hashes a direction v by a few functions floor((a v + b) / w) with
Gaussian a; the slots at both ends are open, so a table has a fixed number of buckets,
which grows with the number of vectors.  A query q knows how its neighbours lie: at the
angle of a true neighbour, a v is Gaussian about cos(angle) a q with deviation
sin(angle), so every perturbed bucket has a probability of holding a neighbour.  The query visits buckets in
order of that estimate until their sum reaches the share that, over all tables, gives
the target recall.  The angle is estimated on a bounded sample; every row is indexed.
Buckets are worked on by region (the first functions of a table): a query goes once to
each region in which it visits buckets, with one bit for each bucket, a region with many
rows is cut into parts, and every task returns the query's best of the buckets that it
visits there.  A task holds the rows of one part and a few of the queries that go there.
The candidates of all tables are merged and ranked by the exact cosine in double precision.

Of equal vectors only the first ``k + 1`` by id are indexed: any other has at least ``k``
equal ones before it, so no result changes.  A query that ends with fewer than ``k``
neighbours visits all buckets.

Defined results for unusual rows: vectors that are null, empty, zero or hold null or
non-finite components take no part, as queries or candidates; shorter vectors count as
filled up with zeros; ties go to the smaller id, null ids last; a repeated query row is
answered for each row, and each finds the others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import map_beside_groups
from .registry import query, table
from .scratch import Scratch
from .vectors import directions, matrix, numbered, sample_directions

SLOTS = 4
# Rows per bucket aimed at, and the bounds of the number of functions.
PER_BUCKET = 24
FUNCTIONS = (3, 7)
REGION_FUNCTIONS = 2
# Rows of a region above which it is cut into parts.
REGION_ROWS = 20_000
# Scores closer than this are told apart by exact sums.
CLOSE = 1e-9
# Queries that a task scores, or sends to their regions, at once.
AT_ONCE = 128
# Sampled vectors held against the whole sample at once on the driver.
PROBES_AT_ONCE = 16


@dataclass(frozen=True)
class Index:
    """Projections of all tables: directions (table, function, width), offsets, cosine."""

    directions: np.ndarray
    offsets: np.ndarray
    cosine: float
    share: float
    width: float = 1.0

    @staticmethod
    def fit(points: np.ndarray, count: int, k: int, recall: float, tables: int, seed: int = 23) -> Index:
        random = np.random.default_rng(seed)
        low, high = FUNCTIONS
        functions = min(high, max(low, round(math.log(max(count, 1) / PER_BUCKET, SLOTS))))
        # Cosine of the k-th neighbour within the sample; it can only be smaller there
        # than among all rows, so buckets enough are visited.
        probes = points[: min(len(points), 400)]
        place = max(0, len(points) - 1 - k)
        near = np.empty(len(probes))
        for n in range(0, len(probes), PROBES_AT_ONCE):
            near[n : n + PROBES_AT_ONCE] = np.partition(probes[n : n + PROBES_AT_ONCE] @ points.T, place, axis=1)[:, place]
        cosine = float(np.clip(np.quantile(near, 0.1), 0.0, 0.999)) if len(points) > 1 else 0.0
        share = 1 - (1 - recall) ** (1 / tables)
        return Index(
            random.normal(size=(tables, functions, points.shape[1])), random.uniform(-0.5, 0.5, (tables, functions)), cosine, share
        )

    def projected(self, points: np.ndarray, t: int) -> np.ndarray:
        return points @ self.directions[t].T

    def buckets(self, points: np.ndarray, t: int) -> np.ndarray:
        """Bucket number of each point in table ``t``."""
        slots = np.floor((self.projected(points, t) + self.offsets[t]) / self.width).astype(np.int64)
        slots = np.clip(slots + SLOTS // 2, 0, SLOTS - 1)
        return slots @ (SLOTS ** np.arange(slots.shape[1])[::-1])

    def visits(self, point: np.ndarray, t: int, share: float) -> np.ndarray:
        """Buckets of table ``t`` in the order of their estimated success, until the
        estimates sum to ``share``."""
        edges = np.array([-math.inf, *range(1 - SLOTS // 2, SLOTS - SLOTS // 2), math.inf])
        edges = edges[None, :] * self.width - self.offsets[t][:, None]
        away = (edges - self.cosine * self.projected(point[None], t).T) / math.sqrt(1 - self.cosine**2)
        below = 0.5 * (1 + np.vectorize(math.erf)(away / math.sqrt(2)))
        inside = np.diff(below, axis=1)
        success = inside[0]
        for own in inside[1:]:
            success = np.multiply.outer(success, own).ravel()
        order = np.argsort(-success, kind="stable")
        if share >= 1:
            return order
        return order[: int(np.searchsorted(np.cumsum(success[order]), share)) + 1]

    @property
    def region_size(self) -> int:
        return SLOTS ** max(0, self.directions.shape[1] - REGION_FUNCTIONS)


def _indexed(classes: DataFrame, index, width: int) -> DataFrame:
    """``place, bucket, row, vec_id, vector`` for every table; ``place`` is table and region."""

    def run(batches):
        own = index.value
        for batch in batches:
            points = directions(matrix(batch.column("vector"), width))
            for t in range(len(own.directions)):
                bucket = own.buckets(points, t)
                place = t * SLOTS**REGION_FUNCTIONS + bucket // own.region_size
                yield pa.record_batch(
                    [pa.array(place, pa.int32()), pa.array(bucket, pa.int32()), *(batch.column(c) for c in ("row", "vec_id", "vector"))],
                    ["place", "bucket", "row", "vec_id", "vector"],
                )

    return classes.select("row", "vec_id", "vector").mapInArrow(run, "place int, bucket int, row bigint, vec_id bigint, vector array<double>")


def _sent(queries: DataFrame, index, width: int, everywhere: bool) -> DataFrame:
    """``place, visits, row, vec_id, vector``: each query with the buckets it visits there,
    a bit for each bucket of the region."""

    def run(batches):
        own = index.value
        for whole in batches:
            for start in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(start, AT_ONCE)
                points = directions(matrix(batch.column("vector"), width))
                places, visits, rows = [], [], []
                for n, point in enumerate(points):
                    for t in range(len(own.directions)):
                        visited = np.zeros(SLOTS ** own.directions.shape[1], bool)
                        visited[own.visits(point, t, 1.0 if everywhere else own.share)] = True
                        visited = visited.reshape(-1, own.region_size)
                        regions = np.flatnonzero(visited.any(axis=1))
                        places += (t * SLOTS**REGION_FUNCTIONS + regions).tolist()
                        visits += [bits.tobytes() for bits in np.packbits(visited[regions], axis=1)]
                        rows += [n] * len(regions)
                taken = pa.array(rows, pa.int64())
                yield pa.record_batch(
                    [pa.array(places, pa.int32()), pa.array(visits, pa.binary()), *(batch.column(c).take(taken) for c in ("row", "vec_id", "vector"))],
                    ["place", "visits", "row", "vec_id", "vector"],
                )

    schema = "place int, visits binary, row bigint, vec_id bigint, vector array<double>"
    return queries.select("row", "vec_id", "vector").repartition(F.col("row")).mapInArrow(run, schema)


class _Part:
    """The indexed rows of one part of a region."""

    def __init__(self, rows: pa.Table, width: int, region_size: int) -> None:
        values = matrix(rows["vector"], width)
        self.points = directions(values)
        self.scaled = _scaled(values)
        self.bucket = rows["bucket"].to_numpy() % region_size
        self.vec_id = rows["vec_id"].to_pylist()
        self.row = rows["row"].to_numpy()
        self.by_row = np.argsort(self.row)
        self.norms: dict[int, float] = {}

    def own(self, row: int) -> np.ndarray:
        """Where the row of that number is."""
        left, right = (np.searchsorted(self.row, row, side, sorter=self.by_row) for side in ("left", "right"))
        return self.by_row[left:right]

    def exact(self, query: np.ndarray, norm: float, n: int) -> float:
        """Cosine from correctly rounded sums: equal vectors give equal scores."""
        if n not in self.norms:
            self.norms[n] = _total(self.scaled[n], self.scaled[n])
        return _total(query, self.scaled[n]) / math.sqrt(norm) / math.sqrt(self.norms[n])


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / np.abs(values).max(axis=1, keepdims=True)


def _total(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum((a * b).tolist())


def _best(places: DataFrame, index, width: int, k: int) -> DataFrame:
    """``query_row, query_id, row, vec_id, score``: of each task, the best of each query."""

    def work(part: _Part, asking: pa.RecordBatch):
        values = matrix(asking.column("vector"), width)
        bits = np.frombuffer(b"".join(asking.column("visits").to_pylist()), np.uint8).reshape(len(values), -1)
        wanted = np.unpackbits(bits, axis=1).astype(bool)
        scores = directions(values) @ part.points.T
        out = []
        for query, visited, score, row, vec_id in zip(
            _scaled(values), wanted, scores, asking.column("row").to_pylist(), asking.column("vec_id").to_pylist()
        ):
            visited = visited[part.bucket]
            visited[part.own(row)] = False
            met = np.flatnonzero(visited)
            if len(met) > k:
                score = score[met]
                least = np.partition(score, len(score) - k)[len(score) - k]
                met = met[score >= least - CLOSE]
            norm = _total(query, query)
            ranked = sorted(
                (-part.exact(query, norm, m), part.vec_id[m] is None, part.vec_id[m] or 0, found) for m, found in zip(met.tolist(), part.row[met].tolist())
            )
            out += [(row, vec_id, found, None if none else name, -score) for score, none, name, found in ranked[:k]]
        if out:
            columns = list(zip(*out))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.float64()])], ["query_row", "query_id", "row", "vec_id", "score"]
            )

    schema = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double"
    prepare = lambda rows: _Part(rows, width, index.value.region_size)
    return map_beside_groups(places.withColumn("asks", F.col("visits").isNotNull()), ["place", "part"], "asks", AT_ONCE, prepare, work, schema)


def _search(indexed: DataFrame, sent: DataFrame, index, width: int, k: int) -> DataFrame:
    # A row for each region of a table: without a broadcast the vectors would be shuffled by it.
    parts = F.broadcast(indexed.groupBy("place").agg(F.ceil(F.count("*") / REGION_ROWS).cast("int").alias("parts")))
    data = indexed.join(parts, "place").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    asked = sent.join(parts, "place").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    none = F.lit(None)
    both = data.select("place", "part", "bucket", none.cast("binary").alias("visits"), "row", "vec_id", "vector").unionByName(
        asked.select("place", "part", none.cast("int").alias("bucket"), "visits", "row", "vec_id", "vector")
    )
    best = _best(both, index, width, k).groupBy("query_row", "row").agg(
        F.first("query_id").alias("query_id"), F.first("vec_id").alias("vec_id"), F.first("score").alias("score")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def nearest(
    rows: DataFrame, asks: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", recall: float = 0.98, tables: int = 2
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row for which
    ``asks`` (on ``vec_id``) is true, among all other rows."""
    scratch = Scratch(rows.sparkSession)
    base = numbered(rows, vec_id, vector, scratch)
    valid = base.where(F.col("cid").isNotNull())
    first = Window.partitionBy("cid").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    kept = scratch.store(valid.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k + 1).drop("copy"), "searched")
    count, width = valid.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    points = sample_directions(kept, count, width)
    index = rows.sparkSession.sparkContext.broadcast(Index.fit(points, count, k, recall, tables))
    queries = valid.where(asks)
    indexed = scratch.store(_indexed(kept, index, width), "indexed")
    found = scratch.store(_search(indexed, _sent(queries, index, width, False), index, width, k), "found")
    enough = found.where(F.col("rank") == min(k, count - 1)).select(F.col("query_row").alias("row"))
    short = scratch.store(queries.join(enough, "row", "left_anti"), "short")
    if short.limit(1).count():
        again = _search(indexed, _sent(short, index, width, True), index, width, k)
        found = found.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


@query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
