"""Mix sources to target weights by hash-threshold histograms.

Every source gets a target number of words.  A whole number of passes over the source
comes first; the rest of the target is a budget that is spent on the documents with the
smallest hashes.  The hash at which the budget ends is found without sorting documents:
words are summed by source and hash bucket, the running total over the buckets says in
which bucket the budget ends, and only that bucket is summed again by the next bits of
the hash, down to single hash values.  The value at which the budget ends counts if that
brings the words nearer to it.  A filter by that one number per source then takes the
documents.  A larger budget only moves the number up, so mixes are nested.

Defined results for unusual rows:

- a null text has size 0, and a document of size 0 takes 0 words;
- a null source is a source of its own, the last in order;
- rows equal in id and text share one hash and so one fate: the taken words of a source
  differ from its target by half the words of one such group at most;
- an empty table gives an empty result; extra columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table

# A word is a run of characters other than space and the ASCII control white space.
WORD = r"[^\x20\x09-\x0D]+"

HASH_BITS = 60
LEVEL_BITS = 12

# Rows of one broadcast table of sources; beyond it the sources are joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text: the same in every run and every engine."""
    key = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("-")),
        F.lit(":"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("-")),
    )
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Target words of each source.

    ``sized`` has ``source`` and ``size``.  Sources in order of code points, null last,
    take the weights in turn and share the sum of all sizes; no target is above ``cap``
    times its source's size, and what is cut off there is shared by the others.  Sharing
    it again and again ends where every source that is not at its cap has the same words
    per unit of weight; that level follows in one step from the sources in order of the
    level at which each reaches its cap.

    The windows here run over one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    reach = Window.orderBy("cap_level", "place")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        sources.withColumn("place", F.row_number().over(names))
        .withColumn("weight", weight)
        .withColumn("cap_level", F.col("source_size") * F.lit(cap) / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn(
            "capped_before",
            F.coalesce(
                F.sum(F.col("source_size") * cap).over(reach.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn("weight_left", F.sum("weight").over(reach.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "level",
            (F.col("total") - F.col("capped_before")).cast("double") / F.col("weight_left").cast("double"),
        )
        .withColumn(
            "common", F.min(F.when(F.col("level") <= F.col("cap_level"), F.struct("cap_level", "place", "level"))).over(everything)
        )
    )
    target = F.least(
        (F.col("source_size") * cap).cast("double"),
        F.coalesce(F.col("common.level") * F.col("weight"), F.lit(float("inf"))),
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        levels.withColumn("target", target)
        .withColumn("passes", passes.cast("bigint"))
        .withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
        .select("source", "source_size", "target", "passes", "budget")
    )


def _level(rows: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """Narrow the bucket in which each source's budget ends by the bits above ``shift``.

    ``state`` has, for each source whose end is still open, the hash prefix of the
    bucket (``prefix``, of the bits above ``outer``) and the words left to spend in it.
    """
    within = (
        rows.withColumn("_outer", F.shiftright("hash", min(shift + LEVEL_BITS, HASH_BITS)))
        .join(
            state.select(F.col("source").alias("_source"), "prefix", "left"),
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("_outer") == F.col("prefix")),
        )
        .groupBy("source", F.shiftright("hash", shift).alias("bucket"))
        .agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    )
    running = Window.partitionBy("source").orderBy("bucket")
    return (
        within.withColumn("upto", F.sum("words").over(running))
        .where(F.col("upto") > F.col("left"))
        .groupBy("source")
        .agg(
            F.min("bucket").alias("prefix"),
            F.min_by(F.col("left") - (F.col("upto") - F.col("words")), "bucket").alias("left"),
            F.min_by("words", "bucket").alias("words"),
        )
    )


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``source, source_size, target, passes, threshold``: documents whose hash is below
    the threshold take one pass more.  A null threshold: all of them do.

    ``sized`` has ``source``, ``size`` and ``hash``, and is read once for every level; a
    level reads only the rows of the bucket that the level before it left open.
    """
    targets = materialize(source_targets(sized, weights, cap), "mix-targets")
    few = targets.count() <= BROADCAST_SOURCES
    state = targets.select("source", F.lit(0).cast("bigint").alias("prefix"), F.col("budget").alias("left"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        state = _level(sized, F.broadcast(state) if few else state, shift)
    nearer = (F.col("words") - F.col("left") < F.col("left")).cast("bigint")
    ends = state.select(F.col("source").alias("_source"), (F.col("prefix") + nearer).alias("threshold"))
    return targets.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "passes", "threshold"
    )


def with_copies(sized: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (how often the mix takes the row)."""
    limits = materialize(limits, "mix-limits")
    if limits.count() <= BROADCAST_SOURCES:
        limits = F.broadcast(limits)
    limits = limits.withColumnRenamed("source", "_source")
    more = F.coalesce(F.col("hash") < F.col("threshold"), F.lit(True)).cast("bigint")
    return (
        sized.join(limits, F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("copies", F.col("passes") + more)
        .drop("_source", "passes", "threshold")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with its columns.

    The totals are found on a stored table of source, size and hash; the texts
    themselves are read once more at the end and are never shuffled.
    """
    measures = F.struct(
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        row_hash(F.col(doc_id), F.col(text)).alias("hash"),
    )
    sized = materialize(docs.select(measures.alias("m")).select("m.*"), "mix-sizes")
    limits = thresholds(sized, weights, cap)
    kept = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), measures.alias("m")).select("doc", "m.*")
    copies = with_copies(packed, limits).where(F.col("copies") > 0)
    repeated = copies.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(*[F.col("doc").getField(c).alias(c) for c in kept])


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-')), 1, 15))::BIGINT AS hash
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM placed),
caps AS (
  SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS cap_level, sum(source_size) OVER () AS total FROM weighed),
levels AS (
  SELECT *,
    CAST(total - coalesce(sum(source_size * 3) OVER (ORDER BY cap_level, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY cap_level, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM caps),
common AS (SELECT level FROM levels WHERE level <= cap_level ORDER BY cap_level, place LIMIT 1),
targets AS (
  SELECT source, source_size, least(CAST(source_size * 3 AS DOUBLE), (SELECT level FROM common) * weight) AS target FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM targets),
spent AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash) AS upto, sum(size) OVER (PARTITION BY source, hash) AS own FROM sized),
judged AS (
  SELECT s.*, b.*, b.target - b.passes * b.source_size AS budget FROM spent s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN upto <= budget OR (upto - own < budget AND upto - budget < budget - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM judged
"""


@query("op4_mix_sources", MIX_SQL)
def op4_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )
    sized = materialize(sized, "mix-sizes")
    mixed = with_copies(sized, thresholds(sized.select("source", "size", "hash")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
