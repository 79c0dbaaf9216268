"""Language identification by averaged hashed subwords and a linear softmax.

A text is the average of the vectors of its subwords (runs of 2 to 4 letters inside
words, word edges marked), each subword hashed to a row of a table; a linear softmax on
the average gives the languages.  Table and softmax are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows, each of which gives a
bounded number of subwords drawn from its whole text; short draws make the model good on
short texts.  Since everything after the hashing is linear, the trained model is one
table of subword rows by languages, and a text is scored by one pass over its letters.

Scores are calibrated: the logits are scaled by a factor that depends on the number of
subwords, fitted on rows that the training did not see.  Rejection is judged piece by
piece, so that a text in several of the languages is not taken for one in none of them: a
piece is known if its margin, by which the best language's mean logit is above the second
one's, reaches a threshold, and a text is rejected if less than half of its subwords are
in known pieces, or if it has no letter.  (Scores do not serve here: with many subwords
they are near 1 for any text.  Margins are small where the subwords are those of no
language, since these speak for one language as much as for another.)  The thresholds,
one for each of several numbers of subwords, are found on those same rows: the lowest one
that gives the wanted precision, but never one that would reject more than a set share of
right predictions of that size.

Defined results for unusual rows: a null text or one without letters is ``und`` with
score 0 and is rejected; texts of any length are read whole, in stretches whose ends
count as word edges; ties between languages go to the first in order; repeated rows get
equal results; with no labelled rows every text is ``und``; an empty table gives an
empty result; columns of the input are kept, the added columns replace those of the same
name.
"""

from __future__ import annotations

import functools
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .sampling import bounded_sample

UNKNOWN = "und"
BITS = 15
STRETCH = 1 << 18

# Bounds of the training sample: rows per language, subwords drawn from each row.
ROWS_PER_LANGUAGE = 800
DRAWS = 512

# Letters and spaces of a piece.
PIECE = 200
# Numbers of subwords that the calibration looks at, besides all draws.
CALIBRATED = (6, 20, 60)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _subwords(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket and piece of each subword, in order, for each length of subwords."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return []
    # Every run of other characters becomes one space, and so do both ends.
    padded = np.zeros(len(points) + 2, bool)
    padded[1:-1] = letter
    kept = padded.copy()
    kept[1:] |= padded[:-1]
    kept[0] = True
    chars = np.full(len(padded), 32, np.uint32)
    np.copyto(chars[1:-1], points, where=letter)
    chars = chars[kept]
    inside = chars != 32
    parts = []
    for n in (2, 3, 4):
        if len(chars) < n:
            break
        last = len(chars) - n + 1
        # A subword may begin or end with a space but not hold one, and holds a letter.
        whole = inside[1:last + 1].copy() if n > 2 else (inside[:last] | inside[1:])
        for k in range(2, n - 1):
            whole &= inside[k : last + k]
        hashed = np.full(last, n * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            hashed += chars[k : last + k]
            hashed *= np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
        parts.append((hashed[whole] >> np.uint32(32 - BITS), np.flatnonzero(whole) // PIECE))
    return parts


def _stretches(text: str) -> list[str]:
    return [text[at : at + STRETCH] for at in range(0, len(text), STRETCH)]


def subword_buckets(text: str) -> np.ndarray:
    """Buckets of all subwords of a text, repeats included."""
    found = [buckets for stretch in _stretches(text) for buckets, _ in _subwords(stretch)]
    return np.concatenate([np.empty(0, np.uint32), *found])


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket by language
    bias: np.ndarray
    scale: tuple[float, float]  # log of the logit factor: intercept, slope by log of subwords
    thresholds: tuple[tuple[float, float], ...]  # by the number of subwords

    def piece_sums(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the subwords' rows (piece by language) and numbers of subwords."""
        sums, counts = [np.zeros((0, len(self.languages)))], [np.zeros(0, np.int64)]
        for stretch in _stretches(text):
            parts = [(buckets, pieces) for buckets, pieces in _subwords(stretch) if len(buckets)]
            size = max((int(pieces[-1]) for _, pieces in parts), default=-1) + 1
            own, many = np.zeros((size, len(self.languages))), np.zeros(size, np.int64)
            for buckets, pieces in parts:
                begins = np.flatnonzero(np.diff(pieces, prepend=-1))
                own[pieces[begins]] += np.add.reduceat(self.table[buckets], begins, axis=0, dtype=np.float64)
                many += np.bincount(pieces, minlength=size)
            sums.append(own[many > 0])
            counts.append(many[many > 0])
        return np.concatenate(sums), np.concatenate(counts)

    def shares(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the languages, a row each."""
        return _softmax((sums / counts[:, None] + self.bias) * _factor(self.scale, counts)[:, None])

    def margins(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _margins(sums / counts[:, None] + self.bias)

    def threshold(self, counts: np.ndarray) -> np.ndarray:
        sizes, least = np.array(self.thresholds).T
        return np.interp(np.log(counts), np.log(sizes), least)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, rejected."""
        sums, counts = self.piece_sums(text or "") if self.languages else (None, ())
        if not len(counts):
            return UNKNOWN, 0.0, True
        shares = self.shares(sums.sum(axis=0)[None], counts.sum()[None])[0]
        known = self.margins(sums, counts) >= self.threshold(counts)
        best = int(shares.argmax())
        return self.languages[best], float(shares[best]), bool(counts[known].sum() * 2 < counts.sum())


def _factor(scale: tuple[float, float], n) -> np.ndarray:
    return np.exp(scale[0] + scale[1] * np.log1p(n))


def _margins(logits: np.ndarray) -> np.ndarray:
    """By how much the best of each row is above the second; of one language its logit."""
    ranked = np.sort(logits, axis=1)
    return ranked[:, -1] - ranked[:, -2] if logits.shape[1] > 1 else ranked[:, -1]


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def train(
    draws: np.ndarray,
    labels: np.ndarray,
    languages: tuple[str, ...],
    width: int = 12,
    epochs: int = 6,
    rate: float = 2.0,
    precision: float = 0.995,
    lost: float = 0.005,
    seed: int = 7,
) -> LanguageModel:
    """Fit on ``draws`` (rows by subword buckets) with ``labels`` (numbers of languages).

    A fifth of the rows is left out for the calibration.
    """
    random = np.random.default_rng(seed)
    order = random.permutation(len(labels))
    aside, used = order[: len(order) // 5], order[len(order) // 5 :]
    k = len(languages)
    rows = random.normal(0, 0.5, (1 << BITS, width)).astype(np.float32)
    weights = random.normal(0, 0.1, (width, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    steps, done = epochs * len(used), 0
    for _ in range(epochs):
        for at in random.permutation(used):
            pace = rate * (1 - done / steps)
            done += 1
            size = int(np.exp(random.uniform(np.log(4), np.log(draws.shape[1]))))
            own = draws[at, random.integers(0, draws.shape[1], size)]
            mean = rows[own].mean(axis=0)
            wrong = _softmax(mean @ weights + bias)
            wrong[labels[at]] -= 1
            back = weights @ wrong
            weights -= pace * 0.1 * np.outer(mean, wrong)
            bias -= pace * 0.01 * wrong
            np.subtract.at(rows, own, pace * 4 / size * back)
    flat = rows @ weights
    if not len(aside):
        aside = order
    # Calibration on short and on full draws of the rows left out.
    logits, sizes, truth = [], [], []
    looked = (*[size for size in CALIBRATED if size < draws.shape[1]], draws.shape[1])
    for at in aside:
        for size in looked:
            logits.append(flat[draws[at, :size]].mean(axis=0) + bias)
            sizes.append(size)
            truth.append(labels[at])
    logits, sizes, truth = np.array(logits), np.array(sizes), np.array(truth)
    best = min(
        ((a, b) for a in np.linspace(-2, 4, 25) for b in np.linspace(0, 1, 11)),
        key=lambda s: -np.log(_softmax(logits * _factor(s, sizes)[:, None])[np.arange(len(truth)), truth] + 1e-12).mean(),
    )
    right, margin = logits.argmax(axis=1) == truth, _margins(logits)
    found = tuple((float(size), _threshold(margin[sizes == size], right[sizes == size], precision, lost)) for size in looked)
    return LanguageModel(languages, flat.astype(np.float32), bias, (float(best[0]), float(best[1])), found)


def _threshold(score: np.ndarray, right: np.ndarray, precision: float, lost: float) -> float:
    """The lowest score at and above which predictions are precise enough, if that does
    not lose more than a share ``lost`` of the right ones."""
    ranked = np.argsort(-score)
    precise = np.cumsum(right[ranked]) / np.arange(1, len(ranked) + 1) >= precision
    wanted = score[ranked[np.flatnonzero(precise)[-1]]] if precise.any() else 1.0
    bound = np.quantile(score[right], lost) if right.any() else 0.0
    return float(min(wanted, bound))


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    draws: int = DRAWS,
) -> LanguageModel:
    """Train on a bounded sample of ``labelled``: at most ``rows_per_language`` rows of
    each language, ``draws`` subwords of each row's whole text.  The draws, a few
    megabytes, are what comes to the driver."""

    @F.arrow_udf("array<int>")
    def drawn(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts.to_pylist():
            buckets = subword_buckets(value or "")
            if len(buckets):
                random = np.random.default_rng(zlib.crc32(value.encode("utf-8", "surrogatepass")))
                buckets = buckets[random.integers(0, len(buckets), draws)]
            out.append(buckets.astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = bounded_sample(known.select(key, F.col(text).alias("text"), F.col(lang).alias("lang")), rows_per_language, key, "lang")
    found = sample.select("lang", drawn("text").alias("draws")).where(F.size("draws") > 0).toArrow()
    if not found.num_rows:
        return LanguageModel((), np.zeros((1, 0), np.float32), np.zeros(0), (0.0, 0.0), ((1.0, 1.0),))
    names = found["lang"].to_pylist()
    languages = tuple(sorted(set(names)))
    matrix = found["draws"].combine_chunks().values.to_numpy().reshape(-1, draws)
    # Rows come in any order of partitions; sorting makes the training repeatable.
    order = np.lexsort((*matrix[:, :4].T, names))
    return train(matrix[order], np.array([languages.index(n) for n in names])[order], languages)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pa.Array) -> pa.Array:
        own = shared.value
        found = [own.predict(value.as_py()) for value in texts]
        names, scores, rejected = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang_pred", "score", "rejected"],
        )

    added = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c not in added]
    # Not deterministic in name only: a filter on the result must not run the model twice.
    run = run.asNondeterministic()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), run(F.col(text).cast("string")).alias("out"))
    return packed.select(*[F.col("doc").getField(c).alias(c) for c in kept], "out.*")


def held_out(folds: int, out: int) -> Column:
    """Whether the checksum of the document's id falls into the fold that is kept out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == out, F.lit(False))


def fit_on_documents(docs: DataFrame) -> LanguageModel:
    return fit(docs.where(~held_out(5, 0)))


@query("op2_identify_language")
def op2_identify_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_on_documents(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score", "rejected")
