"""Compression of vectors to codes: a codebook for each part, fitted by active-entry Lloyd.

Components become integers, vectors are cut into equal parts, and every part position has
a codebook.  A round assigns each part to its nearest entry and moves entries to the mean
of their parts, in integers throughout, so that results do not depend on the order of
sums.  Between rounds every row keeps, stored, the entry of each of its parts and the
exact distance to it.  A part whose assigned entry stayed where it was compares only the
entries that moved with that distance: the others were no nearer and still are not.  Other
parts rescan the whole codebook.  Of equally near entries the lower index wins on both
ways.  Rounds end early once no entry moves.

Each batch of rows adds one summary row with its sums and counts by entry to the stored
table, so that a round reads and writes the rows once; Spark adds the summaries up, and
only parts x entries x width numbers come to the driver.

Defined results for unusual rows: vectors that are null or hold null or non-finite
components are dropped; shorter vectors, and lengths that the number of parts does not
divide, are filled up with zeros; zero and empty vectors take part; components so large
that squared distances would not fit a long are taken as the largest that do; the first
entries come from the smallest ids (null ids last, equal ids by their vector), fewer than
wanted if there are fewer rows; repeated rows count again; an empty table gives an empty
result and empty codebooks.  All columns of the input are kept but the vector, which its
code replaces, and those of the names that are added.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .scratch import Scratch
from .vectors import matrix

# Fixed values of the contract: integers a unit, parts, entries of a codebook, rounds.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# Keys with this share of the rows or more are few and joined by broadcast.
FEW = 10_000

STATE = "q array<long>, entry array<int>, distance array<long>, sums array<long>, counts array<long>"
ADDED = ("entry", "distance", "code", "error")


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, index, position]``, integers."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def distances(part: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = part - entry
    return (apart * apart).sum(axis=1)


def nearest_of(part: np.ndarray, entries: np.ndarray, candidates: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
    """Put the nearer ones of ``candidates`` into ``index`` and ``best``, in place."""
    for j in candidates.tolist():
        found = distances(part, entries[j])
        nearer = (found < best) | ((found == best) & (j < index))
        index[nearer] = j
        best[nearer] = found[nearer]


def assign(q: np.ndarray, entries: np.ndarray, moved: np.ndarray | None, index: np.ndarray | None, best: np.ndarray | None):
    """Nearest entry and squared distance of every part of the rows ``q``.

    ``index`` and ``best`` are those of the last round and ``moved`` tells which entries
    have moved since; None for all of them is a scan of everything.
    """
    parts, count, width = entries.shape
    new_index, new_best = np.empty((len(q), parts), np.int64), np.empty((len(q), parts), np.int64)
    for p in range(parts):
        part = q[:, p * width : (p + 1) * width]
        fixed = np.zeros(len(q), bool) if moved is None else ~moved[p][index[:, p]]
        for rows, known in ((np.flatnonzero(fixed), True), (np.flatnonzero(~fixed), False)):
            if not len(rows):
                continue
            if known:
                own_index, own_best, candidates = index[rows, p], best[rows, p], np.flatnonzero(moved[p])
            else:
                own_index, candidates = np.zeros(len(rows), np.int64), np.arange(1, count)
                own_best = distances(part[rows], entries[p, 0])
            if len(candidates):
                nearest_of(part[rows], entries[p], candidates, own_index, own_best)
            new_index[rows, p], new_best[rows, p] = own_index, own_best
    return new_index, new_best


def sums_by_entry(q: np.ndarray, index: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums (parts, entries, width) and counts (parts, entries) of the parts of each entry."""
    parts = index.shape[1]
    width = q.shape[1] // parts
    sums, counts = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
    for p in range(parts):
        np.add.at(sums[p], index[:, p], q[:, p * width : (p + 1) * width])
        counts[p] = np.bincount(index[:, p], minlength=count)
    return sums, counts


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _pass(state: DataFrame, books: Codebooks, moved: np.ndarray | None) -> DataFrame:
    """All rows with their nearest entries, and one summary row a batch."""
    doc = state.schema["doc"].dataType.simpleString()
    length = books.entries.shape[0] * books.entries.shape[2]
    count = books.entries.shape[1]
    shared = state.sparkSession.sparkContext.broadcast((books.entries, moved))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, moved = shared.value
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            q = matrix(batch.column("q"), length).astype(np.int64, copy=False)
            known = [None, None] if moved is None else [matrix(batch.column(c), len(entries)).astype(np.int64) for c in ("entry", "distance")]
            index, best = assign(q, entries, moved, *known)
            sums, counts = sums_by_entry(q, index, count)
            none = lambda n, kind: pa.nulls(n, pa.list_(kind))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc", "q", "entry", "distance", "sums", "counts"]
            own = [batch.column("doc"), batch.column("q"), _lists(index, kinds[1]), _lists(best, kinds[2]), none(rows, kinds[3]), none(rows, kinds[4])]
            yield pa.RecordBatch.from_arrays(own, names)
            summary = [pa.nulls(1, own[0].type), *[none(1, k) for k in kinds[:3]], _lists(sums.reshape(1, -1), kinds[3]), _lists(counts.reshape(1, -1), kinds[4])]
            yield pa.RecordBatch.from_arrays(summary, names)

    return state.select("doc", "q", "entry", "distance").mapInArrow(run, f"doc {doc}, {STATE}")


def _totals(stored: DataFrame, column: str, length: int) -> list[int]:
    """The summary rows of a column added up, place by place."""
    each = stored.where(F.col("counts").isNotNull()).select(F.posexplode(column).alias("place", "value"))
    rows = each.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    out = [0] * length
    for place, total in rows:
        out[place] = int(total)
    return out


def moved_entries(books: Codebooks, sums: list[int], counts: list[int]) -> Codebooks:
    """Every used entry at the floor of the mean of its parts."""
    flat, width = books.entries.reshape(-1, books.entries.shape[2]).copy(), books.entries.shape[2]
    for i, count in enumerate(counts):
        if count:
            flat[i] = [total // count for total in sums[i * width : (i + 1) * width]]
    return Codebooks(flat.reshape(books.entries.shape))


def _finite(vector):
    doubles = vector.cast("array<double>")
    return F.coalesce(F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def compress(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """The kept rows with ``entry`` and ``distance`` of each part, ``code`` (two hex digits
    a part) and ``error`` (the distances added up), and the codebooks they refer to."""
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("a code has one part at least and 1 to 256 entries")
    scratch = Scratch(rows.sparkSession)
    kept_names = [c for c in rows.columns if c not in (vector, *ADDED)]
    doc = F.struct(*[F.col(f"`{c}`") for c in kept_names]).alias("doc")
    kept = rows.where(_finite(F.col(vector))).select(doc, F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    length = -(-(kept.agg(F.max(F.size("v"))).first()[0] or 0) // parts) * parts
    bound = math.isqrt((1 << 62) // max(1, length)) // 2
    integer = lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(bound))), F.lit(float(-bound))))
    q = F.concat(F.transform("v", integer), F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("v")))
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("entry", "array<int>"), ("distance", "array<long>"))]
    # Without a shuffle: the rows stay dealt as they were read.
    state = scratch.store(kept.select("doc", "id", q.alias("q"), *empty), "codes")
    first = state.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    width = length // parts
    books = Codebooks(np.array([r.q for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy())
    moved = None
    if first:
        for _ in range(rounds):
            state = scratch.replace(_pass(state.where(F.col("doc").isNotNull()), books, moved), "codes")
            counts = _totals(state, "counts", parts * len(first))
            new = moved_entries(books, _totals(state, "sums", parts * len(first) * width), counts)
            moved, books = (new.entries != books.entries).any(axis=2), new
            if not moved.any():
                break
        if moved is None or moved.any():
            state = scratch.replace(_pass(state.where(F.col("doc").isNotNull()), books, moved), "codes")
    digits = F.array_join(F.transform("entry", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda total, d: total + d)
    found = state.where(F.col("doc").isNotNull()).select(
        *[F.col("doc").getField(c).alias(c) for c in kept_names], "entry", "distance", digits.alias("code"), error.alias("error")
    )
    return found, books


def with_group_sums(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of equal ``key``, nulls together.

    Keys with a FEW-th of the rows or more are at most FEW and come by broadcast; the
    others come by a shuffle that the rows of the former do not take part in.
    """
    total = F.sum(F.col(value).cast("decimal(38,0)")).try_cast("long")
    sums = Scratch(rows.sparkSession).store(rows.groupBy(F.col(key).alias("_key")).agg(total.alias("_sum"), F.count("*").alias("_count")), "sums")
    whole = sums.agg(F.sum("_count"), F.count("*")).first()
    least = math.ceil((whole[0] or 0) / FEW)
    hot = sums.where(F.col("_count") >= least).select("_key", "_sum", F.lit(True).alias("_hot"))
    out = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    if sums.where(F.col("_count") < least).isEmpty():
        return out.withColumnRenamed("_sum", name).drop("_hot")
    rest = sums.where(F.col("_count") < least).select("_key", F.col("_sum").alias("_rest"), F.lit(0).alias("_zero"))
    salt = F.when(F.col("_hot"), 1 + F.pmod(F.xxhash64(value), F.lit(1 << 20))).otherwise(0).cast("int")
    apart = out.withColumn("_salt", salt)
    met = apart.join(rest, (F.col("_salt") == F.col("_zero")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.withColumn(name, F.when(F.col("_hot"), F.col("_sum")).otherwise(F.col("_rest"))).drop(
        "_key", "_sum", "_rest", "_zero", "_salt", "_hot"
    )


def _oracle() -> str:
    rounds = [
        f"""
kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, q) AS row, * FROM kept),
cells AS MATERIALIZED (
    SELECT row, p, d, q[p * (len(q) // {PARTS}) + d + 1] AS v
    FROM (SELECT row, q, p, unnest(range(len(q) // {PARTS})) AS d FROM (SELECT row, q, unnest(range({PARTS})) AS p FROM numbered))
),
book0 AS MATERIALIZED (SELECT p, row - 1 AS e, d, v FROM cells WHERE row <= {ENTRIES})"""
    ]
    for k in range(ROUNDS + 1):
        rounds.append(f"""
best{k} AS MATERIALIZED (
    SELECT row, p, min([dist, e]) AS near FROM (
        SELECT c.row, c.p, b.e, CAST(sum((c.v - b.v) * (c.v - b.v)) AS BIGINT) AS dist
        FROM cells c JOIN book{k} b ON b.p = c.p AND b.d = c.d GROUP BY c.row, c.p, b.e)
    GROUP BY row, p
)""")
        if k < ROUNDS:
            rounds.append(f"""
book{k + 1} AS MATERIALIZED (
    SELECT b.p, b.e, b.d, coalesce(m.v, b.v) AS v
    FROM book{k} b LEFT JOIN (
        SELECT p, e, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v
        FROM (SELECT c.p, a.near[2] AS e, c.d, sum(c.v) AS s, count(*) AS n
              FROM cells c JOIN best{k} a ON a.row = c.row AND a.p = c.p GROUP BY c.p, a.near[2], c.d)) m
    ON m.p = b.p AND m.e = b.e AND m.d = b.d
)""")
    return f"""WITH {",".join(rounds)},
coded AS (
    SELECT n.vec_id, n.label, string_agg(printf('%02x', near[2]), '' ORDER BY p) AS code, CAST(sum(near[1]) AS BIGINT) AS error
    FROM best{ROUNDS} b JOIN numbered n ON n.row = b.row GROUP BY b.row, n.vec_id, n.label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, d)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded"""


@query("op12_vector_codes", sql=_oracle())
def op12_vector_codes(spark, sf_dir):
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    summed = with_group_sums(coded, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
