"""Near copies among embeddings: spherical k-means cells, blocked products, components.

Equal vectors are one class from the start.  Spherical k-means on a bounded sample gives
the cells; every class stands in the cell of its nearest centre, and is also sent to the
other cells whose border it is near.  Near is such that no link is lost: let x stand in
cell A and y in cell B.  Then (A - B)x >= 0 and (B - A)y >= 0, and their sum is at most
|A - B| |x - y|, so for one of the two it is at most half of that, where |x - y| is the
root of 2 - 2 * threshold or less.  That vector is sent to the other's cell.

Within a cell all vectors that stand there are compared with all that are in it, in
blocks, by products in double precision.  A pair that meets in both cells counts in the
lower one.  Blocks give the number of links per class and the edges of a spanning forest;
components join the forests.  Pairs are never listed.

Defined results for unusual rows: vectors that are null, empty, zero or hold null or
non-finite components link with nothing; shorter vectors count as filled up with zeros;
equal vectors link with each other; the component of a row is the smallest id in it
(null if there is none) and the rows with that id are kept; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_groups
from .components import components
from .registry import query, table
from .scratch import Scratch
from .vectors import directions, matrix, numbered, sample_directions

CLASSES_PER_CELL = 1500
MOST_CELLS = 1024
BLOCK = 2048
STRIPE = 256


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centres of length one.  Empty cells are placed anew on random points."""
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), cells, replace=False)]
    for _ in range(rounds):
        home = np.concatenate([(points[at : at + 4096] @ centres.T).argmax(axis=1) for at in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        empty = lengths < 1e-9
        sums[empty] = points[random.integers(0, len(points), int(empty.sum()))]
        lengths[empty] = 1
        centres = sums / lengths[:, None]
    return centres


class Cells:
    """Centres, and the rule by which a vector is sent to other cells."""

    def __init__(self, centres: np.ndarray, threshold: float) -> None:
        self.centres, self.threshold = centres, threshold
        apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
        # Half of the greatest distance of linked vectors, and a little for rounding.
        self.reach = apart * (math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-6) + 1e-9

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cell of each point, and which cells it is in."""
        near = points @ self.centres.T
        home = near.argmax(axis=1)
        gap = near[np.arange(len(points)), home][:, None] - near
        visited = gap <= self.reach[home]
        visited[np.arange(len(points)), home] = True
        return home, visited


def _dealt(classes: DataFrame, cells, width: int) -> DataFrame:
    """``cell, home, cid, n_rows, vector``: a row for each cell that a class is in."""

    def run(batches):
        own = cells.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                points = directions(matrix(part.column("vector"), width))
                home, visited = own.visits(points)
                rows, found = np.nonzero(visited)
                yield pa.record_batch(
                    {
                        "cell": pa.array(found, pa.int32()),
                        "home": pa.array(home[rows], pa.int32()),
                        "cid": part.column("cid").take(pa.array(rows)),
                        "n_rows": part.column("n_rows").take(pa.array(rows)),
                        "point": pa.array([points[row].tobytes() for row in rows], pa.binary()),
                    }
                )

    return classes.select("cid", "n_rows", "vector").mapInArrow(run, "cell int, home int, cid string, n_rows bigint, point binary")


def _in_tasks(dealt: DataFrame) -> DataFrame:
    """Deal the rows of each cell to tasks (``left``, ``right``), by blocks of hashes.

    Residents, which have their home in the cell, meet each other and all visitors;
    visitors do not meet.  Blocks of residents are numbered first, those of visitors
    after them: a pair of resident blocks is a task, and so is every block of visitors
    with every block of residents.
    """
    resident = F.col("home") == F.col("cell")
    blocks = lambda count: F.ceil(count / F.lit(BLOCK)).cast("int")
    sizes = dealt.groupBy("cell").agg(
        blocks(F.count_if(resident)).alias("_residents"), blocks(F.count_if(~resident)).alias("_visitors")
    )
    number = lambda of: F.pmod(F.xxhash64("cid", F.lit("block")), F.col(of)).cast("int")
    placed = dealt.join(sizes.where("_residents > 0"), "cell").withColumn(
        "block", F.when(resident, number("_residents")).otherwise(F.col("_residents") + number("_visitors"))
    )
    own = F.sequence(F.lit(0), F.col("_residents") - 1)
    pair = lambda a, b: F.struct(a.alias("left"), b.alias("right"))
    block = F.col("block")
    among = F.transform(own, lambda k: pair(F.least(block, k), F.greatest(block, k)))
    none = F.array().cast("array<struct<left:int,right:int>>")
    others = F.transform(F.sequence(F.lit(0), F.col("_visitors") - 1), lambda k: pair(block, F.col("_residents") + k))
    with_others = F.concat(among, F.when(F.col("_visitors") > 0, others).otherwise(none))
    visits = F.transform(own, lambda k: pair(k, block))
    tasks = placed.withColumn("_task", F.explode(F.when(resident, with_others).otherwise(visits)))
    return tasks.select("cell", "home", "cid", "n_rows", "point", "block", "_task.left", "_task.right")


def _roots(labels: np.ndarray, of: np.ndarray) -> np.ndarray:
    found = labels[of]
    while True:
        further = labels[found]
        if (further == found).all():
            return found
        found = further


def _links(dealt: DataFrame, cells) -> DataFrame:
    """``a, b, n``: for each class of a task its number of linked rows there, and a class
    that its links lead to."""

    def work(group: pa.Table):
        if group.num_rows < 2:
            return
        own = cells.value
        cell = group["cell"][0].as_py()
        points = np.frombuffer(b"".join(group["point"].to_pylist())).reshape(group.num_rows, -1)
        home, n_rows = group["home"].to_numpy(), group["n_rows"].to_numpy()
        here = home == cell
        _, visited = own.visits(points)
        left, right = group["left"][0].as_py(), group["right"][0].as_py()
        block = group["block"].to_numpy()
        ours, theirs = np.flatnonzero(block == left), np.flatnonzero(block == right)
        links, labels = np.zeros(len(home), np.int64), np.arange(len(home))
        for at in range(0, len(ours), STRIPE):
            a = ours[at : at + STRIPE]
            linked = points[a] @ points[theirs].T >= own.threshold
            if left == right:
                linked &= a[:, None] < theirs[None, :]
            # Pairs of two visitors meet at home; pairs that meet twice count in the lower cell.
            first = here[a][:, None] & (here[theirs] | ~(visited[a][:, home[theirs]] & (home[theirs] < cell)))
            second = (~here[a] & here[theirs][:, None] & ~(visited[theirs][:, home[a]] & (home[a] < cell))).T
            linked &= first | second
            links[a] += linked @ n_rows[theirs]
            links[theirs] += n_rows[a] @ linked
            for row in np.flatnonzero(linked.any(axis=1)):
                joined = np.append(theirs[linked[row]], a[row])
                roots = _roots(labels, joined)
                labels[roots] = labels[joined] = roots.min()
        rows = np.flatnonzero(links)
        if len(rows):
            ids = group["cid"]
            yield pa.table({"a": ids.take(pa.array(rows)), "b": ids.take(pa.array(_roots(labels, rows))), "n": pa.array(links[rows])})

    return map_groups(dealt, ["cell", "left", "right"], work, "a string, b string, n bigint")


def near_copies(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """A row per vector: ``vec_id, n_links, component, kept``."""
    scratch = Scratch(rows.sparkSession)
    base = numbered(rows, vec_id, vector, scratch)
    valid = base.where(F.col("cid").isNotNull())
    classes = valid.groupBy("cid").agg(F.count("*").alias("n_rows"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    classes = scratch.store(classes, "vector-classes")
    count, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if count:
        points = sample_directions(classes, count, width)
        cells = min(MOST_CELLS, max(1, count // CLASSES_PER_CELL), len(points))
        shared = rows.sparkSession.sparkContext.broadcast(Cells(spherical_kmeans(points, cells), threshold))
        dealt = scratch.store(_dealt(classes, shared, width), "cells")
        links = scratch.store(_links(_in_tasks(dealt), shared), "vector-links")
    else:
        links = rows.sparkSession.createDataFrame([], "a string, b string, n bigint")
    groups = components(links.select("a", "b")).withColumnsRenamed({"node": "cid", "component": "root"})
    n_links = links.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n_links"))
    linked = classes.select("cid", "n_rows", "least").join(n_links, "cid", "left").join(groups, "cid", "left")
    linked = linked.withColumn("root", F.coalesce("root", "cid"))
    linked = scratch.store(linked, "vector-groups")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    result = linked.join(least, "root").select(
        "cid", (F.coalesce("n_links", F.lit(0)) + F.col("n_rows") - 1).alias("n_links"), "component"
    )
    found = valid.select("vec_id", "cid").join(result, "cid").drop("cid")
    alone = base.where(F.col("cid").isNull()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)))


NEAR_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id GROUP BY e.vec_id
"""


@query("op1_embedding_dedup", NEAR_SQL)
def op1_embedding_dedup(spark, sf_dir):
    return near_copies(table(spark, sf_dir, "embeddings")).withColumnRenamed("component", "component_id")
