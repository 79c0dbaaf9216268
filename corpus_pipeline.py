"""A training-corpus pipeline over ``documents``.

1. ``language_id``: texts that the language model rejects go.
2. ``jaccard_join``: of each group of near copies one text stays.
3. ``secret_scan``: reported spans are replaced by a mark; no text goes.
4. ``mix_sources``: every text comes as often as its source's target wants.
5. ``byte_bpe``: texts become token ids; the decoded bytes are checked against the text.

Every stage but the last returns the columns of ``documents``.  ``n_chars`` is set anew
where a stage changes the text.

Defined results for unusual rows: null and empty texts, and texts without a letter, are
rejected by the first stage; where a later stage meets one, it links with nothing, holds
no secret, has size 0 and so is in the mix only by whole passes over its source, and is
encoded as no ids.  Texts of any length are taken whole.  Of rows that repeat an id and a
text one stays after the second stage; rows that repeat an id alone are texts of their
own.  Null ids and sources are values like others.  An empty table passes through all
stages as an empty one.  Further columns of ``docs``, whatever their names, are kept as
they are by all stages but the last, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard, language, mixing, secrets, tokens
from millrace.llm.scratch import Scratch
from millrace.llm.shipping import ship, small_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(ship(spark))
    model = language.fit_on_documents(docs)
    names = docs.columns
    # Only the verdict is added to the rows; columns of these names in docs stay as they are.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col("text").alias("text"))
    kept = language.identify(whole, model).where(~F.col("rejected"))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in names])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(ship(spark))
    return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast("bigint"))
    return redacted.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(ship(spark))
    encoded = tokens.encode(docs.select("doc_id", "source", "text"), tokens.public_vocabulary())
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return encoded.select(
        "doc_id",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == whole).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# SQL cannot train or apply the language model, nor encode; tests compare the stages with
# plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
