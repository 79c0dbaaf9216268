"""Grouping of spelling variants: words one edit apart, by a reduced alphabet.

Letters are hashed to a few symbols.  Words of one edit apart have reduced words of at
most one edit apart, so the full one-edit neighbourhood of every distinct reduced word
(deletions, replacements and insertions over the few symbols) is generated and joined
with the reduced vocabulary; the pairs of words behind the matches are verified on the
original strings.  The number of symbols follows from the size of the vocabulary, so that
few words share a reduced word and a neighbourhood stays short.

Reduced words and neighbours are 64-bit polynomial hashes, which numpy gives for a whole
neighbourhood from one cumulative sum: a word of a million letters costs eight bytes a
neighbour.  A neighbourhood is generated whole; of the two ends of a reduced pair the one
with the smaller hash finds it, so every pair of words is verified once.

Defined results for unusual rows: null and empty texts have no words; a null id counts as
an empty one in the hash that places deletions; texts and words of any length are taken
whole; repeated rows count again; an empty table gives no words.  Of equal counts the
word that is smaller in code-point order wins.  Only the two named columns are read, so
other columns of any name do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .scratch import Scratch

# Fixed values of the contract: letters of a run, the shortest word, the least count, the
# divisor of the hashes that place a deletion, and how much more frequent a form is.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7
LEAST_COUNT = 2
DELETES = 31
RATIO = 10

# Words that share a reduced word are few if the symbols to the power of this exceed the
# number of words.
REACH = 9
# Neighbours that are generated at a time.
SLICE = 1 << 20

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def corpus_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: lower-cased runs of letters, some with one letter deleted by hash,
    that have SHORTEST code points and LEAST_COUNT occurrences at least."""
    runs = F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0)))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    found = found.where(F.length("run") >= SHORTEST)
    hashed = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DELETES == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def symbols_for(count: int) -> int:
    """Size of the reduced alphabet for a vocabulary of ``count`` words."""
    return max(3, math.ceil(count ** (1 / REACH)))


def symbol_values(symbols: int) -> np.ndarray:
    """The 64-bit value of every code point's symbol; code points from 256 on fold."""
    number = np.array([zlib.crc32(b"letter %d" % code) % symbols for code in range(256)], np.uint64)
    return _values(symbols)[number.astype(np.intp)]


def _values(symbols: int) -> np.ndarray:
    """Odd values far apart, one a symbol."""
    spread = [(k + 1) * 0xBF58476D1CE4E5B9 & MASK for k in range(symbols)]
    return np.array([(v ^ v >> 29) * 0x94D049BB133111EB & MASK | 1 for v in spread], np.uint64)


def _powers(count: int) -> np.ndarray:
    """BASE to the power of 0 up to ``count`` - 1, modulo 2^64."""
    out = np.full(count, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points (a row a word) of the words of each length."""
    listed = words.to_pylist()
    lengths = np.fromiter(map(len, listed), np.int64, len(listed))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        joined = "".join([listed[i] for i in places]).encode("utf-32-le")
        yield places, np.frombuffer(joined, np.uint32).reshape(len(places), length)


def reduce_words(words: pa.Array, symbols: int) -> np.ndarray:
    """Hashes of the reduced words."""
    values, out = symbol_values(symbols), np.zeros(len(words), np.int64)
    for places, codes in _by_length(words):
        out[places] = (values[codes & 255] * _powers(codes.shape[1])[::-1]).sum(axis=1, dtype=np.uint64).view(np.int64)
    return out


def neighbourhood(codes: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the reduced words and, a row each, of all their one-edit neighbours
    (with repeats), for words of one length given as code points."""
    length = codes.shape[1]
    powers, choices = _powers(length + 1), _values(symbols)
    weights = powers[:length][::-1]
    letters = symbol_values(symbols)[codes & 255]
    weighed = letters * weights
    before = np.zeros((len(codes), length + 1), np.uint64)
    np.cumsum(weighed, axis=1, dtype=np.uint64, out=before[:, 1:])
    own = before[:, -1:]
    after = own - before
    shorter = before[:, :-1] * np.uint64(pow(BASE, -1, 1 << 64)) + after[:, 1:]
    replaced = own[:, :, None] + (choices[None, None, :] - letters[:, :, None]) * weights[None, :, None]
    longer = (before * np.uint64(BASE) + after)[:, :, None] + choices[None, None, :] * powers[::-1][None, :, None]
    rows = len(codes)
    return own[:, 0], np.concatenate([shorter, replaced.reshape(rows, -1), longer.reshape(rows, -1)], axis=1)


def _neighbours(symbols: int):
    """Rows ``word`` to ``owner, key``: every neighbour above the word's own hash, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _by_length(batch.column("word")):
                width = (codes.shape[1] + 1) * (2 * symbols + 1)
                step = max(1, SLICE // width)
                for start in range(0, len(codes), step):
                    own, keys = neighbourhood(codes[start : start + step], symbols)
                    own, keys = own.view(np.int64), keys.view(np.int64)
                    keys.sort(axis=1)
                    wanted = keys > own[:, None]
                    wanted[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                    owners = np.repeat(own, wanted.sum(axis=1))
                    yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(keys[wanted])], ["owner", "key"])

    return run


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of the stored ``word, n`` one edit apart, once."""
    symbols = symbols_for(words.count())

    @F.arrow_udf("long")
    def reduced(column: pa.Array) -> pa.Array:
        return pa.array(reduce_words(column, symbols))

    words = scratch.store(words.select("word", "n", reduced("word").alias("reduced")), "reduced")
    alphabet = "".join(map(chr, range(0x61, 0x7B))) + "".join(map(chr, range(0xC0, 0x100)))
    names = "".join(chr(0x100 + zlib.crc32(b"letter %d" % ord(c)) % symbols) for c in alphabet)
    # Two reduced words of one hash, should they occur, are both kept.
    second = F.xxhash64(F.translate("word", alphabet, names))
    vocabulary = scratch.store(words.groupBy("reduced", second.alias("second")).agg(F.min("word").alias("word")), "vocabulary")
    keys = vocabulary.select(F.col("reduced").alias("key"))
    found = vocabulary.select("word").mapInArrow(_neighbours(symbols), "owner long, key long").join(keys, "key", "left_semi")
    pairs = found.select("owner", "key").unionByName(keys.select(F.col("key").alias("owner"), "key")).distinct()
    first = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("reduced").alias("owner"))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("reduced").alias("key"))
    verified = ((F.col("owner") != F.col("key")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    met = pairs.join(first, "owner").join(other, "key").where(verified)
    return met.select("a", "a_n", "b", "b_n")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row of ``word, n``.

    ``form`` is the near word of the largest count, if that is ``ratio`` times the word's
    own at least; ``root`` is the end of the chain of forms.
    """
    scratch = Scratch(words.sparkSession)
    words = scratch.store(words.select("word", "n"), "words")
    most = words.agg(F.max("n")).first()[0] or 1
    near = near_words(words, scratch)
    directed = near.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")).alias("to")).unionByName(
        near.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("form")).alias("to"))
    )
    best = directed.groupBy("word").agg(F.count("*").alias("n_near"), F.min("to").alias("to"))
    is_form = -F.col("to.less") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("to.form")).alias("form"),
        F.when(is_form, -F.col("to.less")).alias("form_n"),
    )
    formed = scratch.store(formed, "formed")
    # Counts grow by the ratio with every step, so a chain is short; every join doubles
    # the part of it that a word has walked.
    steps = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("end"))
    walked, longest = 1, math.ceil(math.log(max(most, ratio), max(ratio, 2))) + 1
    while walked < longest:
        further = steps.select(F.col("word").alias("end"), F.col("end").alias("next"))
        steps = scratch.store(steps.join(further, "end", "left").select("word", F.coalesce("next", "end").alias("end")), f"steps{walked}")
        walked *= 2
    out = formed.join(steps, "word", "left").withColumn("root", F.coalesce("end", "word")).drop("end")
    scratch.drop("words", "reduced", "vocabulary")
    return out.select("word", "n", "n_near", "form", "form_n", "root")


CRC_SQL = """
    crc_table AS (
        SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT] || range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
    )"""

SQL = f"""
WITH {CRC_SQL.strip()},
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents
),
hashed AS (
    SELECT run, xor(list_reduce([4294967295] || list_transform(range(1, length(code), 2), lambda i: CAST('0x' || substr(code, i, 2) AS BIGINT)),
               lambda c, b: xor(c >> 8, entries[1 + (xor(c, b) & 255)])), 4294967295) AS h
    FROM (SELECT run, hex(encode(id || ':' || run)) AS code FROM runs WHERE length(run) >= {SHORTEST}), crc_table
),
counted AS (
    SELECT CASE WHEN h % {DELETES} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, count(*) AS n FROM counted WHERE length(word) >= {SHORTEST} GROUP BY word HAVING count(*) >= {LEAST_COUNT}
),
cuts AS (
    SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS cut
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
    UNION
    SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON b.cut = a.word
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near
    FROM near
),
formed AS (
    SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near,
           CASE WHEN p.other_n >= {RATIO} * w.n THEN p.other END AS form,
           CASE WHEN p.other_n >= {RATIO} * w.n THEN p.other_n END AS form_n
    FROM words w LEFT JOIN placed p ON p.word = w.word AND p.place = 1
),
chain AS (
    SELECT word, word AS at FROM formed
    UNION ALL
    SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.at AS root
FROM formed f
JOIN (SELECT c.word, c.at FROM chain c JOIN formed e ON e.word = c.at WHERE e.form IS NULL) r ON r.word = f.word
""".replace("WITH crc_table", "WITH RECURSIVE crc_table", 1)


@query("op11_spelling_variants", sql=SQL)
def op11_spelling_variants(spark, sf_dir):
    return variants(corpus_words(table(spark, sf_dir, "documents")))
