"""Passages that repeat across documents: paragraph MinHash banding, anchored runs, components.

Equal texts are one class from the start: each different text is scanned once, and what
is found in it holds for all documents that have it.

Paragraphs are lines of at least ``words`` words; neighbouring shorter lines are taken
together, on and back from each of them as many as have ``words`` words. Equal
paragraphs are one class; the others are banded: the minwise sketch of a paragraph's
five-word shingles is cut into bands, tuned so that two paragraphs at the threshold
share a band almost surely. Paragraphs that collide are joined, verified by exact
Jaccard similarity on their whole shingle sets, and clustered by components. Colliding
paragraphs of a band are dealt to tasks in pairs of blocks, and a pair is verified only
in the first band that it shares.

A repeated passage may also stand anywhere else in a text, over lines and from the middle
of a sentence on.  Every run of ``words`` words has an anchor, the least hash of the
shorter runs in it, so that equal runs have equal anchors.  Runs of neighbouring words
with one anchor make a stretch.  An anchor of several documents whose stretches are all
equal repeats in whole; where they differ, at the ends of an equal passage, the texts are
read again and the runs themselves compared.  So every run of ``words`` words that is
equal in two documents is found, and nothing else; neighbouring runs make one passage.

The first occurrence of a repeat, by document id and place, is kept and all others are
removals; overlapping removals of a document are one.

Defined results for unusual rows: null, empty and short texts have no passages; a class
that occurs in one document only is no repeat; null ids come last in order; rows that
repeat an id are documents of their own, also those that repeat its text; an empty table
gives an empty result; whole texts are read, and no band, bucket or partner is dropped.
Only the two named columns are read; ``without_repeats`` keeps all others, whatever their
names.
"""

from __future__ import annotations

import functools
import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import in_block_pairs
from .components import components
from .jaccard import BROADCAST_IDS, JoinSettings, likely_members, set_id, verified_links
from .registry import query, table
from .scratch import Scratch
from .shingles import WORDS, hash_values, minima, mixed


@dataclass(frozen=True)
class PassageSettings:
    words: int = 50
    threshold: float = 0.8
    recall: float = 0.999
    rows: int = 3  # sketch values of a band

    @property
    def bands(self) -> int:
        """The fewest bands that reach the recall at the threshold."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.rows))

    @property
    def join(self) -> JoinSettings:
        return JoinSettings(threshold=self.threshold, sketch=self.bands * self.rows)


@functools.cache
def _spaces() -> np.ndarray:
    return np.fromiter((chr(c).isspace() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


# An odd base for hashes of runs of words, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
# Powers that are kept, and words of a text whose sketches are made at once.
STEP = 1 << 14


def _powers(base: int, n: int) -> np.ndarray:
    if n <= STEP:
        return _first_powers(base)[:n]
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@functools.cache
def _first_powers(base: int) -> np.ndarray:
    out = np.full(STEP, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end."""
    space = np.ones(len(points) + 2, bool)
    space[1:-1] = _spaces()[points]
    turns = np.flatnonzero(space[:-1] != space[1:])
    return turns[::2], turns[1::2]


def _range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each range of the values, the same wherever it stands."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(values) * _powers(BASE, n), dtype=np.uint64, out=sums[1:])
    return mixed((sums[end] - sums[start]) * _powers(INVERSE, n)[start] ^ (end - start).astype(np.uint64))


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(hashes)
    fresh = ordered[1:] != ordered[:-1]
    return ordered if fresh.all() else ordered[np.concatenate([np.ones(1, bool), fresh])]


class _Words:
    """Words of a text with their places, lines and sentence ends."""

    def __init__(self, text: str) -> None:
        points = _points(text)
        self.starts, self.ends = _bounds(points)
        line = np.cumsum(points == 10)[self.starts] if len(self.starts) else self.starts
        # A letter may be longer in lower case, which moves the words after it.
        small = text.lower()
        places = (self.starts, self.ends) if len(small) == len(text) else _bounds(_points(small))
        self.hashes = _range_hashes(_points(small).astype(np.uint64), *places)
        n = len(self.hashes)
        # Lines as ranges of words.
        changes = np.flatnonzero(np.diff(line)) + 1
        self.lines = list(zip([0, *changes.tolist()], [*changes.tolist(), n])) if n else []

    def units(self, words: int) -> list[tuple[int, int]]:
        """Lines with enough words, and of neighbouring shorter lines, from every line on and
        from every line back the fewest that have enough together."""
        out, short = [], []
        for start, end in [*self.lines, (0, words)]:
            if end - start < words:
                short.append((start, end))
                continue
            if short and short[-1][1] - short[0][0] >= words:
                begins, closes = np.array(short, np.int64).T
                close = np.searchsorted(closes, begins + words, "left")
                begin = np.searchsorted(begins, closes - words, "right") - 1
                on, back = close < len(closes), begin >= 0
                spans = {*zip(begins[on].tolist(), closes[close[on]].tolist()), *zip(begins[begin[back]].tolist(), closes[back].tolist())}
                out += sorted(spans)
            short = []
            out.append((start, end))
        return out[:-1]

    def shingle_sets(self, spans: list[tuple[int, int]]) -> list[np.ndarray]:
        """Sorted distinct shingles of each run of words."""
        if not spans:
            return []
        whole = self._shingles
        short = lambda start, end: self.run_hashes(np.array([start]), np.array([end])).view(np.uint64)
        return [_distinct(whole[start : end - WORDS + 1] if end - start >= WORDS else short(start, end)) for start, end in spans]

    @functools.cached_property
    def _shingles(self) -> np.ndarray:
        """Hashes of all shingles, repeats included."""
        at = np.arange(max(0, len(self.hashes) - WORDS + 1))
        return self.run_hashes(at, at + WORDS).view(np.uint64)

    def sketches(self, spans: list[tuple[int, int]], sets: list[np.ndarray], count: int) -> np.ndarray:
        """The least of each hash function over each run of words; ``sets`` are their shingles."""
        ends = np.array(spans, np.int64).reshape(-1, 2) - [0, WORDS - 1]
        if not len(ends) or len(self.hashes) > STEP or (ends[:, 0] >= ends[:, 1]).any():
            return np.array([minima(found, count) for found in sets], np.uint32).reshape(-1, count)
        # All runs at once: every second range of the flat bounds is one of them.
        values = hash_values(np.append(self._shingles, np.uint64(0)), count)
        return np.minimum.reduceat(values, ends.ravel(), axis=1)[:, ::2].T

    @functools.cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.hashes)
        sums = np.cumsum(mixed(self.hashes) * _powers(BASE, n), dtype=np.uint64)
        return np.concatenate([np.zeros(1, np.uint64), sums]), _powers(INVERSE, n)

    def run_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash for each run of words, the same wherever the run stands."""
        sums, inverse = self._sums
        return mixed((sums[end] - sums[start]) * inverse[start] ^ (end - start).astype(np.uint64)).view(np.int64)

    def stretches(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, hash, and the first words of the first and last run of each stretch."""
        n, short = len(self.hashes) - words + 1, max(1, words // ANCHOR)
        if n < 1:
            return (np.empty(0, np.int64),) * 4
        at = np.arange(len(self.hashes) - short + 1)
        hashes, span = self.run_hashes(at, at + short), words - short + 1
        # The first of equal least hashes, so the place depends on the run alone and never
        # moves back from one run to the next.  Windows are doubled, the last two overlap.
        least, place, width = hashes, at, 1
        while width < span:
            by = min(width, span - width)
            place = np.where(least[by:] < least[:-by], place[by:], place[:-by])
            least, width = np.minimum(least[by:], least[:-by]), width + by
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], n) - 1
        return hashes[place[first]], self.run_hashes(first, last + words), first, last


LINES = "array<struct<sid:binary,size:int,begin:int,finish:int,sketch:binary,keys:array<bigint>>>"
STRETCHES = "array<struct<anchor:bigint,hash:bigint,begin:int,finish:int>>"
RUNS = "array<struct<hash:bigint,begin:int,finish:int>>"
# An anchor is a run of this part of the words of a run.
ANCHOR = 5
# Places of stretches that are broadcast with their texts.
BROADCAST_PLACES = 2_000_000
# Texts with this share of the documents are few and joined by broadcast.
FEW = 10_000


def _listed(parts: list[tuple[np.ndarray, ...]], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    """An array of structs for each part, from its columns."""
    offsets = np.cumsum([0, *[len(part[0]) for part in parts]])
    columns = [np.concatenate([part[n] for part in parts] or [np.empty(0)]) for n in range(len(fields))]
    structs = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def _text_id(text: Column) -> Column:
    """A digest of a text; null without one."""
    return F.when(text != "", F.unhex(F.md5(text.cast("binary"))))


def _broadcast(table: DataFrame, rows: int) -> DataFrame:
    """A stored table, broadcast if it has no more rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def _scanned(docs: DataFrame, copied: DataFrame, settings: PassageSettings) -> DataFrame:
    """``doc_id, text_id, many, lines, stretches`` of each different text; places are code
    points, and ``many`` tells that several documents have the text.  Of those only the
    first is scanned."""
    count = settings.bands * settings.rows

    @F.arrow_udf(f"lines {LINES}, stretches {STRETCHES}")
    def run(texts: pa.Array) -> pa.Array:
        salts = mixed(np.arange(1, settings.bands + 1, dtype=np.uint64))
        parts, least, sids, stretches = [], [np.empty((0, count), np.uint32)], [], []
        for value in texts:
            words = _Words(value.as_py() or "")
            units = words.units(settings.words)
            sets = words.shingle_sets(units)
            least.append(words.sketches(units, sets, count))
            sids += map(set_id, sets)
            start, end = np.array(units, np.int64).reshape(-1, 2).T
            parts.append((words.starts[start], words.ends[end - 1], np.array([len(found) for found in sets], np.int64)))
            anchors, hashes, first, last = words.stretches(settings.words)
            stretches.append((anchors, hashes, words.starts[first], words.ends[last + (settings.words - 1)]))
        whole = np.concatenate(least)
        keys = np.tile(salts, (len(whole), 1))
        for row in range(settings.rows):
            keys = mixed(keys ^ whole[:, row :: settings.rows].astype(np.uint64))
        sketches = ((whole * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
        begin, finish, size = (pa.array(np.concatenate([np.empty(0, np.int64), *column]), pa.int32()) for column in (list(zip(*parts)) or [()] * 3))
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * settings.bands, pa.int32()), pa.array(keys.view(np.int64).ravel()))
        line = pa.StructArray.from_arrays(
            [pa.array(sids, pa.binary()), size, begin, finish, pa.array([x.tobytes() for x in sketches], pa.binary()), listed],
            ["sid", "size", "begin", "finish", "sketch", "keys"],
        )
        lines = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(part[0]) for part in parts]]), pa.int32()), line)
        fields = [("anchor", pa.int64()), ("hash", pa.int64()), ("begin", pa.int32()), ("finish", pa.int32())]
        return pa.StructArray.from_arrays([lines, _listed(stretches, fields)], ["lines", "stretches"])

    first = copied.select("text_id", F.col("first.doc_id").alias("_first"), F.lit(True).alias("many"))
    texts = docs.where(F.col("text_id").isNotNull()).join(_broadcast(first, BROADCAST_IDS), "text_id", "left")
    texts = texts.where(F.col("many").isNull() | F.col("doc_id").eqNullSafe(F.col("_first")))
    return texts.select("doc_id", "text_id", F.coalesce("many", F.lit(False)).alias("many"), run("text").alias("s")).select("doc_id", "text_id", "many", "s.*")


def _place() -> Column:
    """Where an occurrence stands, in order: nulls last."""
    return F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_id", "begin")


def _several() -> Column:
    """Whether the rows of a group are of several documents."""
    text = F.xxhash64("text_id")
    return (F.min(text) != F.max(text)) | F.max("many")


def _with_shingles(candidates: DataFrame, docs: DataFrame, sets: DataFrame, settings: PassageSettings, scratch: Scratch) -> DataFrame:
    """Candidates with their whole sets, made anew from the first occurrence of each."""
    wanted = candidates.select("sid").distinct().join(sets.select("sid", "first"), "sid")
    wanted = wanted.groupBy(F.col("first.text_id").alias("_id"), F.col("first.doc_id").alias("_doc")).agg(F.collect_set("first.begin").alias("_begins"))
    texts = _texts_of(docs, scratch.store(wanted, "wanted-lines"))

    @F.arrow_udf("array<struct<sid:binary,shingles:binary>>")
    def run(values: pa.Array, begins: pa.Array) -> pa.Array:
        out = []
        for value, places in zip(values, begins.to_pylist()):
            words, places, own = _Words(value.as_py() or ""), set(places), []
            units = [unit for unit in words.units(settings.words) if int(words.starts[unit[0]]) in places]
            own += [{"sid": set_id(found), "shingles": found.tobytes()} for found in words.shingle_sets(units)]
            out.append(own)
        return pa.array(out, pa.list_(pa.struct([("sid", pa.binary()), ("shingles", pa.binary())])))

    made = texts.select(F.explode(run.asNondeterministic()("text", "_begins")).alias("s")).select("s.*")
    return candidates.join(scratch.store(made.dropDuplicates(["sid"]), "line-shingles"), "sid")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts that a stored ``_id, _doc, _begins`` names, with the places asked for."""
    size = wanted.agg(F.count("*"), F.sum(F.size("_begins"))).first()
    chosen = F.broadcast(wanted) if size[0] <= BROADCAST_IDS and (size[1] or 0) <= BROADCAST_PLACES else wanted
    return docs.join(chosen, (F.col("text_id") == F.col("_id")) & F.col("doc_id").eqNullSafe(F.col("_doc")))


def _equal_runs(base: DataFrame, docs: DataFrame, settings: PassageSettings, scratch: Scratch) -> DataFrame:
    """``text_id, begin, finish, first`` of runs that are equal in several documents."""
    stretches = base.select("doc_id", "text_id", "many", F.inline("stretches"))
    # First the anchors alone, then the places of those that several documents have.
    shared = stretches.groupBy("anchor").agg((F.min("hash") == F.max("hash")).alias("equal"), _several().alias("several"))
    shared = scratch.store(shared.where("several").select("anchor", "equal"), "anchors")
    anchored = scratch.store(stretches.join(shared, "anchor").drop("hash", "many"), "anchored")
    scratch.drop("anchors")
    firsts = anchored.where("equal").groupBy("anchor").agg(F.min(_place()).alias("first"))
    whole = anchored.where("equal").join(firsts, "anchor").select("text_id", "begin", "finish", "first")

    differing = anchored.where("not equal").groupBy(F.col("text_id").alias("_id"), F.col("doc_id").alias("_doc")).agg(F.collect_set("begin").alias("_begins"))
    texts = _texts_of(docs, scratch.store(differing, "wanted-stretches"))

    @F.arrow_udf(RUNS)
    def run(values: pa.Array, begins: pa.Array) -> pa.Array:
        out = []
        for value, places in zip(values, begins):
            words = _Words(value.as_py() or "")
            _, _, first, last = words.stretches(settings.words)
            asked = np.isin(words.starts[first], places.values.to_numpy(zero_copy_only=False))
            first, last = first[asked], last[asked]
            # All runs of the stretches that are asked for.
            many = last - first + 1
            at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            out.append((words.run_hashes(at, at + settings.words), words.starts[at], words.ends[at + settings.words - 1]))
        return _listed(out, [("hash", pa.int64()), ("begin", pa.int32()), ("finish", pa.int32())])

    read = texts.select("doc_id", "text_id", run.asNondeterministic()("text", "_begins").alias("runs"))
    copies = base.where("many").select("text_id", "many").distinct()
    read = scratch.store(read.join(copies, "text_id", "left").withColumn("many", F.coalesce("many", F.lit(False))), "stretch-runs")
    runs = read.select("doc_id", "text_id", "many", F.inline("runs"))
    shared = runs.groupBy("hash").agg(_several().alias("several"), F.min(_place()).alias("first"))
    shared = scratch.store(shared.where("several").select("hash", "first"), "shared-runs")
    edges = runs.join(shared, "hash").select("text_id", "begin", "finish", "first")
    return scratch.store(whole.unionByName(edges), "equal-runs")


def _near_lines(base: DataFrame, docs: DataFrame, settings: PassageSettings, scratch: Scratch) -> DataFrame:
    """``text_id, begin, finish, first`` of equal and near lines of several documents."""
    sets = base.select("doc_id", "text_id", "many", F.inline("lines")).groupBy("sid").agg(
        F.count("*").alias("n_docs"),
        F.min(F.xxhash64("text_id")).alias("low"),
        F.max(F.xxhash64("text_id")).alias("high"),
        F.max("many").alias("many"),
        F.min(_place()).alias("first"),
        *[F.first(c).alias(c) for c in ("size", "sketch", "keys")],
    )
    sets = scratch.store(sets, "line-sets")
    banded = sets.select("sid", F.explode("keys").alias("key"))
    sizes = scratch.store(banded.groupBy("key").count().where("count > 1"), "band-sizes")
    colliding = banded.join(sizes, "key").groupBy("sid").agg(F.collect_set("key").alias("keys"))
    members = sets.select("sid", "size", "n_docs", "sketch").join(colliding, "sid").withColumn("key", F.explode("keys"))
    members = in_block_pairs(members, sizes, "key", "sid", settings.join.bucket)
    likely = scratch.store(likely_members(members, settings.join), "likely-lines")
    links = scratch.store(verified_links(_with_shingles(likely, docs, sets, settings, scratch), settings.join), "line-links")
    scratch.drop("band-sizes", "likely-lines", "wanted-lines", "line-shingles")
    groups = components(links.select("a", "b")).withColumnsRenamed({"node": "sid", "component": "root"})
    grouped = sets.select("sid", "first", "low", "high", "many").join(groups, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    several = (F.min("low") != F.max("high")) | F.max("many")
    roots = grouped.groupBy("root").agg(F.min("first").alias("first"), several.alias("several")).where("several")
    repeated = grouped.select("sid", "root").join(roots.select("root", "first"), "root").select("sid", "first")
    light = F.transform("lines", lambda x: F.struct(x["sid"].alias("sid"), x["begin"].alias("begin"), x["finish"].alias("finish")))
    lines = base.select("text_id", F.inline(light))
    found = scratch.store(lines.join(repeated, "sid").select("text_id", "begin", "finish", "first"), "near-lines")
    scratch.drop("scanned", "line-sets", "line-links")
    return found


def _merged(found: DataFrame, fate: Column, name: str) -> DataFrame:
    """``text_id`` and, as ``name``, its passages: overlapping occurrences of one fate."""
    fated = found.select("text_id", "begin", "finish", F.col("first.doc_id").alias("class_id"), fate.alias("kept"))
    ordered = Window.partitionBy("text_id", "kept").orderBy("begin", "finish")
    fresh = F.coalesce(F.col("begin") > F.max("finish").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    numbered = fated.withColumn("fresh", fresh.cast("int")).withColumn("passage", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    passages = numbered.groupBy("text_id", "kept", "passage").agg(
        F.min("begin").alias("begin"), F.max("finish").alias("finish"), F.min("class_id").alias("class_id")
    )
    return passages.groupBy("text_id").agg(F.collect_list(F.struct("begin", "finish", "class_id", "kept")).alias(name))


def _passages(docs: DataFrame, settings: PassageSettings, scratch: Scratch) -> DataFrame:
    """``doc_id, row, begin, finish, class_id, kept`` for ``doc_id, row, text``."""
    docs = docs.withColumn("text_id", _text_id(F.col("text")))
    rows = scratch.store(docs.where(F.col("text_id").isNotNull()).select("doc_id", "row", "text_id"), "rows")
    texts = rows.groupBy("text_id").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("first"))
    copied = scratch.store(texts.where("n > 1"), "copied-texts")
    base = scratch.store(_scanned(docs.drop("row"), copied, settings), "scanned")
    runs = _equal_runs(base, docs.drop("row"), settings, scratch)
    scratch.drop("anchored", "wanted-stretches", "stretch-runs", "shared-runs")
    found = runs.unionByName(_near_lines(base, docs.drop("row"), settings, scratch))
    # In the first document of a text a passage may be the kept one, in its copies not.
    first = (F.col("first.text_id") == F.col("text_id")) & (F.col("first.begin") == F.col("begin"))
    own = _merged(found, first, "own")
    copies = _merged(found.join(copied.select("text_id"), "text_id", "left_semi"), F.lit(False), "copies")
    spans = scratch.store(own.join(copies, "text_id", "left"), "spans")
    scratch.keep_only("rows", "copied-texts", "spans")
    # Texts with many copies are few, and their rows are not brought together.
    least = math.ceil((copied.agg(F.sum("n")).first()[0] or 0) / FEW)
    hot = F.broadcast(copied.where(F.col("n") >= least).select("text_id"))
    rare = rows.join(hot, "text_id", "left_anti").join(spans, "text_id")
    often = rows.join(hot, "text_id", "left_semi").join(F.broadcast(spans.join(hot, "text_id", "left_semi")), "text_id")
    firsts = _broadcast(copied.select("text_id", F.col("first.row").alias("_first")), BROADCAST_IDS)
    placed = rare.unionByName(often).join(firsts, "text_id", "left")
    is_first = F.col("_first").isNull() | (F.col("row") == F.col("_first"))
    return placed.select("doc_id", "row", F.inline(F.when(is_first, F.col("own")).otherwise(F.col("copies"))))


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: PassageSettings | None = None
) -> DataFrame:
    """A row per occurrence of a repeated passage: ``doc_id, begin, finish, class_id,
    kept``.  ``class_id`` is the document that holds the kept occurrence."""
    numbered = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    return _passages(numbered, settings or PassageSettings(), Scratch(docs.sparkSession)).drop("row")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: PassageSettings | None = None) -> DataFrame:
    """``docs`` with the removals cut out of their texts; no row is dropped.

    The rows are stored with a number of their own first, by which spans come back to
    them, so rows may repeat ids and texts.
    """
    scratch = Scratch(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    stored = scratch.store(docs.select(F.monotonically_increasing_id().alias("row"), whole), "numbered")
    own = stored.select(F.col("doc").getField(doc_id).alias("doc_id"), "row", F.col("doc").getField(text).cast("string").alias("text"))
    gone = _passages(own, settings or PassageSettings(), Scratch(docs.sparkSession)).where("not kept")
    gone = gone.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("begin", "finish"))).alias("spans"))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, own in zip(texts.to_pylist(), spans.to_pylist()):
            if value is not None and own:
                pieces, at = [], 0
                for span in own:
                    pieces.append(value[at : max(at, span["begin"])])
                    at = max(at, span["finish"])
                value = "".join([*pieces, value[at:]])
            out.append(value)
        return pa.array(out, pa.string())

    marked = stored.join(gone, "row", "left").withColumn("cut", cut(F.col("doc").getField(text).cast("string"), "spans"))
    return marked.select(*[F.col("cut").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])


@query("op7_repeated_passages")
def op7_repeated_passages(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
