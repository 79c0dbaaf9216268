"""Similarity join of texts on word n-grams by chosen paths.

Every text is the set of its five-word shingles, and two texts are linked if the Jaccard
similarity of their sets is at least the threshold.  Texts with equal sets are one class
from the start.  The join runs several times.  In each run the sets are split by shared
sampled tokens, again and again: a node of the recursion samples positions of the minwise
sketch, ``1 / threshold`` of them on average, and a set goes to one child for each of
them, chosen by its value there.  A node with few sets is a bucket, in which all sets are
compared; so is what is left at the greatest depth, where the sets of a bucket are dealt
to tasks in pairs of blocks.  Two sets at the threshold meet in one run with a
probability that follows from the branching, and the number of runs is the least that
reaches the target recall.

Within a bucket, sketches rule out most pairs, and the pairs left are verified on their
whole sets.  A pair that meets in several buckets counts in the first of them only, which
both sets know, so that links are counted once without being listed.  Buckets give the
number of links per set and the edges of a spanning forest; components join the forests.

Defined results for unusual rows: a null, empty or blank text has no shingles and links
with nothing; a text of fewer than five words has one shingle; texts with equal sets are
linked (similarity 1), repeated rows too; of a component the row with the smallest id is
kept, of rows with that id one; null ids come last; an empty table gives an empty result.
Whole texts are read, and no bucket, partner or candidate is dropped.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Forest, in_block_pairs, map_whole_groups
from .components import components
from .registry import query, table
from .scratch import Scratch
from .shingles import minima, mixed, shingle_set

# Rows of a set of ids that is broadcast; more are joined by shuffle.
BROADCAST_IDS = 500_000


@dataclass(frozen=True)
class JoinSettings:
    threshold: float = 0.8
    recall: float = 0.999
    sketch: int = 128
    depth: int = 4
    bucket: int = 512
    # Standard deviations by which a sketch may fall short of the threshold.
    slack: float = 3.5

    def meeting(self, depth: int) -> float:
        """Probability that two sets at the threshold share a node of that depth."""
        if depth == 0:
            return 1.0
        child = self.threshold * self.meeting(depth - 1)
        more = 1 / self.threshold - 1  # probability of a second sampled position
        return 1 - (1 - more) * (1 - child) - more * (1 - child) ** 2

    @property
    def runs(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.meeting(self.depth)))

    @property
    def least_matches(self) -> int:
        """Equal sketch bytes below which a pair is not verified."""
        t = self.threshold
        share = t + (1 - t) / 256 - self.slack * math.sqrt(t * (1 - t) / self.sketch)
        return math.floor(share * self.sketch)

    def first_positions(self) -> list[tuple[int, int]]:
        """(run, position) of the root nodes."""
        random = np.random.default_rng(19)
        out = []
        for run in range(self.runs):
            count = 1 + int(random.random() < 1 / self.threshold - 1)
            out += [(run, int(p)) for p in random.choice(self.sketch, count, replace=False)]
        return out


@functools.lru_cache(maxsize=4)
def _roots(settings: JoinSettings) -> tuple[np.ndarray, np.ndarray]:
    pairs = settings.first_positions()
    positions = np.array([p for _, p in pairs])
    salts = mixed(np.array([(r << 16) + p + 1 for r, p in pairs], np.uint64))
    return positions, salts


def set_id(hashes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketched(docs: DataFrame, doc_id: str, text: str, settings: JoinSettings) -> DataFrame:
    """``doc_id, sid, size, sketch, keys``: the set of each text by a digest, its sketch
    in bytes, and its first buckets.  A text without words has a null ``sid``."""

    @F.arrow_udf("sid binary, size int, sketch binary, keys array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        positions, salts = _roots(settings)
        ids, sizes, sketches, keys = [], [], [], []
        for value in texts:
            found = shingle_set(value.as_py())
            if not len(found):
                for column in (ids, sizes, sketches, keys):
                    column.append(None)
                continue
            least = minima(found, settings.sketch)
            ids.append(set_id(found))
            sizes.append(len(found))
            sketches.append(((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
            keys.append(mixed(least[positions].astype(np.uint64) ^ salts).view(np.int64))
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["sid", "size", "sketch", "keys"],
        )

    return docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text).cast("string")).alias("s")).select("doc_id", "s.*")


def _buckets(sets: DataFrame, settings: JoinSettings, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Final buckets (``key, sid``) with more than one set, and their sizes."""
    rows = sets.select("sid", F.explode("keys").alias("key"))
    done = None
    for depth in range(1, settings.depth + 1):
        counts = scratch.store(rows.groupBy("key").count().where("count > 1"), f"paths-{depth}")
        large = counts.where(F.col("count") > settings.bucket)
        last = depth == settings.depth or not large.limit(1).count()
        small = counts if last else counts.where(F.col("count") <= settings.bucket)
        finished = rows.join(small.select("key"), "key")
        done = finished if done is None else done.unionByName(finished)
        if last:
            break
        # Both samples of a node follow from its key, so that all its sets agree.
        draw = lambda n: F.pmod(F.xxhash64("key", F.lit(n)), F.lit(settings.sketch)).cast("int")
        unit = F.pmod(F.xxhash64("key", F.lit(0)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        second = F.when(unit < 1 / settings.threshold - 1, draw(2))
        positions = F.array_distinct(F.array_compact(F.array(draw(1), second)))
        inner = rows.join(large.select("key"), "key").join(sets.select("sid", "sketch"), "sid")
        inner = inner.select("sid", "key", "sketch", F.explode(positions).alias("at"))
        child = F.xxhash64("key", "at", F.substring(F.col("sketch"), F.col("at") + 1, F.lit(1)))
        rows = scratch.store(inner.select("sid", child.alias("key")), f"paths-rows-{depth}")
    final = scratch.store(done.distinct(), "buckets")
    return final, scratch.store(final.groupBy("key").count().where("count > 1"), "bucket-sizes")


def _column(table: pa.Table, name: str, kind, width: int) -> np.ndarray:
    """Binary values of equal length as a matrix."""
    return np.frombuffer(b"".join(table[name].to_pylist()), kind).reshape(-1, width)


def _likely_pairs(groups: pa.Table, ends: np.ndarray, settings: JoinSettings, done=lambda a, b: np.zeros(len(a), bool)):
    """Pairs of rows of many tasks at once whose sizes and sketches allow the threshold, and
    whose first common bucket is that of their task.  ``ends`` tells for each row where its
    task ends; pairs that are ``done`` are left out."""
    at = np.flatnonzero(np.arange(groups.num_rows) + 1 < ends)
    if not len(at):
        return
    sketch, size = _column(groups, "sketch", np.uint8, settings.sketch), groups["size"].to_numpy()
    key, block = groups["key"].to_numpy(), groups["block"].to_numpy()
    same = groups["left"].to_numpy() == groups["right"].to_numpy()
    listed = groups["keys"].combine_chunks()
    values, offsets = listed.values.to_numpy(), listed.offsets.to_numpy()
    lists = functools.cache(lambda row: set(values[offsets[row] : offsets[row + 1]].tolist()))
    step = 0
    while len(at):
        step += 1
        a = at[same[at] | (block[at] != block[at + step])]
        small, large = np.minimum(size[a], size[a + step]), np.maximum(size[a], size[a + step])
        a = a[small >= settings.threshold * large]
        a = a[np.count_nonzero(sketch[a] == sketch[a + step], axis=1) >= settings.least_matches]
        for row in a[~done(a, a + step)].tolist():
            if min(lists(row) & lists(row + step)) == key[row]:
                yield row, row + step
        at = at[at + step + 1 < ends[at]]


def likely_members(members: DataFrame, settings: JoinSettings) -> DataFrame:
    """Rows of ``members`` that have a likely partner in their task."""

    def work(groups: pa.Table, ends: np.ndarray):
        used = np.zeros(groups.num_rows, bool)
        for pair in _likely_pairs(groups, ends, settings, lambda a, b: used[a] & used[b]):
            used[list(pair)] = True
        if used.any():
            yield groups.take(np.flatnonzero(used))

    names = ["key", "left", "right", "block", "sid", "size", "n_docs", "sketch", "keys"]
    schema = "key bigint, left int, right int, block int, sid binary, size int, n_docs bigint, sketch binary, keys array<bigint>"
    return map_whole_groups(members.select(names), ["key", "left", "right"], work, schema)


def verified_links(candidates: DataFrame, settings: JoinSettings) -> DataFrame:
    """``a, b, n``: for each set of a task its number of linked texts there, and the
    smallest set that its links lead to."""

    def work(groups: pa.Table, ends: np.ndarray):
        pairs: dict[int, list[tuple[int, int]]] = {}
        for a, b in _likely_pairs(groups, ends, settings):
            pairs.setdefault(int(ends[a]), []).append((a, b))
        ids, n_docs, shingles = groups["sid"].to_pylist(), groups["n_docs"].to_numpy(), groups["shingles"]
        order = sorted(range(len(ids)), key=ids.__getitem__)
        rank = {row: place for place, row in enumerate(order)}
        forest, links = Forest(len(ids)), [0] * len(ids)
        for own in pairs.values():
            # The sets of one task, and of these only those with a likely partner.
            rows = sorted({row for pair in own for row in pair})
            place = {row: n for n, row in enumerate(rows)}
            sets = [np.frombuffer(shingles[row].as_py(), np.uint64) for row in rows]
            for (a, b), common in zip(own, _common(sets, [(place[a], place[b]) for a, b in own])):
                if common >= settings.threshold * (len(sets[place[a]]) + len(sets[place[b]]) - common) - 1e-9:
                    links[a] += int(n_docs[b])
                    links[b] += int(n_docs[a])
                    forest.join(rank[a], rank[b])
        rows = [row for row in range(len(ids)) if links[row]]
        if rows:
            yield pa.table(
                {
                    "a": pa.array([ids[row] for row in rows], pa.binary()),
                    "b": pa.array([ids[order[forest.root(rank[row])]] for row in rows], pa.binary()),
                    "n": pa.array([links[row] for row in rows], pa.int64()),
                }
            )

    return map_whole_groups(candidates, ["key", "left", "right"], work, "a binary, b binary, n bigint")


# Above so many pairs of a task, their common shingles are counted by matrix product.
FEW_PAIRS = 2000
COLUMNS = 4096


def _common(sets: list[np.ndarray], pairs: list[tuple[int, int]]) -> list[int]:
    """Sizes of the intersections of the pairs."""
    if len(pairs) <= FEW_PAIRS:
        return [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    kept = shared[columns]
    rows, columns = rows[kept], number[columns[kept]]
    left, right = (np.array(side) for side in zip(*pairs))
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(columns, [start, start + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[rows[low:high], columns[low:high] - start] = 1
        total += block @ block.T
    return total[left, right].astype(np.int64).tolist()


def _with_shingles(candidates: DataFrame, docs: DataFrame, sets: DataFrame, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    """Candidates with their whole sets, made anew from one text of each set."""
    wanted = scratch.store(candidates.select("sid").distinct().join(sets.select("sid", "first_id"), "sid"), "wanted")
    chosen = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    texts = texts.join(chosen, F.col("_id").eqNullSafe(F.col("first_id")))

    @F.arrow_udf("own binary, shingles binary")
    def run(values: pa.Array) -> pa.Array:
        found = [shingle_set(value.as_py()) for value in values]
        return pa.StructArray.from_arrays(
            [pa.array([set_id(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], ["own", "shingles"]
        )

    made = texts.select("sid", run.asNondeterministic()("_text").alias("s")).select("sid", "s.*")
    # An id that stands for several texts gives several sets; the wanted one is kept.
    made = made.where(F.col("own") == F.col("sid")).select("sid", "shingles").dropDuplicates(["sid"])
    return candidates.join(scratch.store(made, "shingles"), "sid")


@dataclass
class Joined:
    """Result of a join: ``rows`` has a row per text (``doc_id, sid, n_links, component,
    kept``; ``component`` is the smallest id of the component, null without one)."""

    rows: DataFrame


def join_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: JoinSettings | None = None) -> Joined:
    settings = settings or JoinSettings()
    scratch = Scratch(docs.sparkSession)
    sketched = _sketched(docs, doc_id, text, settings).withColumn("row", F.monotonically_increasing_id())
    base = scratch.store(sketched, "sketches")
    known = base.where(F.col("sid").isNotNull())
    classes = known.groupBy("sid").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_id"))
    once = known.groupBy("sid").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    sets = scratch.store(classes.join(once, "sid"), "sets")

    final, sizes = _buckets(sets, settings, scratch)
    lists = final.groupBy("sid").agg(F.collect_set("key").alias("keys"))
    members = sets.drop("keys").join(lists, "sid").withColumn("key", F.explode("keys"))
    members = in_block_pairs(members, sizes, "key", "sid", settings.bucket)
    candidates = scratch.store(likely_members(members, settings), "candidates")
    links = scratch.store(verified_links(_with_shingles(candidates, docs, sets, doc_id, text, scratch), settings), "links")

    n_links = links.groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("n_links"))
    groups = components(links.select("a", "b")).withColumnsRenamed({"node": "sid", "component": "root"})
    linked = classes.join(n_links, "sid", "left").join(groups, "sid", "left")
    linked = scratch.store(linked.withColumn("root", F.coalesce("root", "sid")), "classes")
    # The first row of a component: the smallest id, and of rows with that id the first.
    first = known.join(linked.select("sid", "root"), "sid").groupBy("root")
    first = first.agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("first"))
    chosen = linked.join(first, "root").select("sid", "n_docs", "n_links", "first")
    rows = known.select("doc_id", "sid", "row").join(chosen, "sid")
    rows = rows.select(
        "doc_id",
        "sid",
        (F.coalesce("n_links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
        F.col("first.doc_id").alias("component"),
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    alone = base.where(F.col("sid").isNull()).select(
        "doc_id", "sid", F.lit(0).cast("bigint").alias("n_links"), F.col("doc_id").alias("component"), F.lit(True).alias("kept")
    )
    joined = Joined(scratch.store(rows.unionByName(alone), "joined"))
    scratch.keep_only("joined")
    return joined


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: JoinSettings | None = None) -> DataFrame:
    """``docs`` with one text of each component, all columns kept.

    Texts are not shuffled while the ids to drop are few enough to broadcast.  An id that
    stands both for a kept and for a dropped row is settled by the text.
    """
    rows = join_texts(docs, doc_id, text, settings).rows
    per_id = rows.groupBy(F.col("doc_id").alias("_drop")).agg(
        F.bool_or("kept").alias("_some"), F.bool_and("kept").alias("_all")
    )
    mark = per_id.where(~F.col("_all"))
    size = mark.count()
    mark = F.broadcast(mark) if size <= BROADCAST_IDS else mark
    marked = docs.join(mark, F.col(doc_id).eqNullSafe(F.col("_drop")), "left")
    plain = marked.where(F.col("_some").isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
    if not rows.where("not kept").join(rows.where("kept").select("doc_id").distinct(), "doc_id", "left_semi").limit(1).count() and not rows.where("doc_id is null and not kept").limit(1).count():
        return plain
    settings = settings or JoinSettings()
    unclear = marked.where("_some").select(*[F.col(f"`{c}`") for c in docs.columns])
    kept = rows.where("kept").select(F.col("doc_id").alias("_kept"), F.col("sid").alias("_sid"))
    again = _sketched(unclear.withColumn("_whole", F.struct(*[F.col(f"`{c}`") for c in docs.columns])), "_whole", text, settings)
    again = again.select(F.col("doc_id").alias("_whole"), F.coalesce("sid", F.lit(b"")).alias("_own"))
    found = again.join(kept, F.col(f"_whole.{doc_id}").eqNullSafe(F.col("_kept")) & (F.col("_own") == F.coalesce("_sid", F.lit(b""))))
    found = found.groupBy("_kept", "_own").agg(F.first("_whole").alias("_whole"))
    return plain.unionByName(found.select(*[F.col("_whole").getField(c).alias(c) for c in docs.columns]))


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS w FROM documents),
shingle AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE c.n >= 0.8 * (x.n + y.n - c.n) - 1e-9),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, (SELECT count(*) FROM link WHERE a = d.doc_id) AS n_links, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""


@query("op6_jaccard_join", JACCARD_SQL)
def op6_jaccard_join(spark, sf_dir):
    rows = join_texts(table(spark, sf_dir, "documents").select("doc_id", "text")).rows
    return rows.select("doc_id", "n_links", F.col("component").alias("component_id"), "kept")
