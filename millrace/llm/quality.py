"""Quality scores by a factorisation machine.

Features of a text are its hashed words (log counts, scaled to length one), statistics of
its structure cut into steps, and metadata columns cut into steps.  The score is a bias,
a weight per feature, and a low-rank interaction for every pair of features; the sum over
pairs is half of (square of the sum minus sum of the squares) of the features' factor
vectors, so that scoring is linear in the number of features.

Training is stochastic gradient descent in numpy on a bounded sample of labelled rows,
drawn per label; the share of the labels in all labelled rows enters as a weight.  Scores
are calibrated on rows that the training did not see.

Defined results for unusual rows: a null text is scored as an empty one; an empty text has
no words and scores by its structure; texts of any length are read whole; a null in a
metadata column is a step of its own; repeated rows get equal scores; with labels of one
kind only, or none, every score is the share of good labels (or one half); an empty table
gives an empty result; columns of the input are kept, the added columns replace those of
the same name.
"""

from __future__ import annotations

import functools
import math
import operator
import sys
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import held_out
from .registry import query, table
from .sampling import bounded_sample

WORD_BUCKETS = 1 << 14
STEPS = 12

# Bound of the training sample: labelled rows per label.
ROWS_PER_LABEL = 3000

# Classes of characters, by general category.
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol")
STOPS = ".,;:!?'\"()-"

# Each statistic with the values at which it changes step.
SHARES = (0.001, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 0.99)
LENGTHS = (1, 3, 10, 30, 60, 120, 250, 500, 1000, 3000, 10000)
STATISTICS = {
    "upper": SHARES,
    "digit": SHARES,
    "stop": SHARES,
    "symbol": SHARES,
    "words": LENGTHS,
    "word_length": (1.5, 2.5, 3.5, 4, 4.5, 5, 5.5, 6, 7, 9, 14),
    "words_in_line": LENGTHS,
    "distinct": SHARES,
    "commonest": SHARES,
    "repeated": SHARES,
    "shouted": SHARES,
    "bare": SHARES,
    "odd_end": SHARES,
    "line_repeated": SHARES,
}


@functools.cache
def _classes() -> np.ndarray:
    def of(point: int) -> int:
        char = chr(point)
        kind = unicodedata.category(char)
        if char in STOPS:
            return 4
        if char.isspace() or kind[0] in "CZ":
            return 3
        return {"Lu": 1, "Lt": 1, "Nd": 2, "Nl": 2, "No": 2}.get(kind, 0 if kind[0] in "LM" else 5)

    return np.fromiter(map(of, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def statistics(text: str, words: list[str]) -> list[float]:
    """The numbers of STATISTICS, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(len(CLASSES), np.int64)
    for at in range(0, len(points), 1 << 20):
        counts += np.bincount(_classes()[points[at : at + (1 << 20)]], minlength=len(CLASSES))
    lower, upper, digit, _, stop, symbol = counts.tolist()
    visible = max(1, lower + upper + digit + stop + symbol)
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    tally = Counter(words)
    ends = [word[-1] for word in words]
    end_counts = Counter(ends)
    odd = sum(k for char, k in end_counts.items() if not char.isalnum() and char not in ".,;:?'\")")
    return [
        upper / max(1, lower + upper),
        digit / visible,
        stop / visible,
        symbol / visible,
        len(words),
        visible / n,
        len(words) / max(1, len(lines)),
        len(tally) / n,
        max(tally.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(k for word, k in tally.items() if len(word) > 1 and word.isupper()) / n,
        sum(k for word, k in tally.items() if not any(map(str.isalnum, word))) / n,
        odd / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]


def _step(values, edges) -> int:
    return int(np.searchsorted(edges, values, side="right"))


@functools.lru_cache(maxsize=200_000)
def _word_bucket(word: str) -> int:
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORD_BUCKETS


def _extra(name: str, value) -> int:
    """Feature of a metadata value: its name with the step of its size, or its text."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        value = int(np.log2(1 + abs(value)) * 2) if math.isfinite(value) else "large"
    return zlib.crc32(f"{name}={value}".encode("utf-8", "surrogatepass"))


EXTRA_BUCKETS = 1 << 8
FEATURES = WORD_BUCKETS + STEPS * len(STATISTICS) + EXTRA_BUCKETS


def features(text: str | None, metadata: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the features of a text, each number once."""
    text = text or ""
    words = text.split()
    tally: Counter = Counter()
    for word, count in Counter(words).items():
        tally[_word_bucket(word)] += count
    numbers = np.fromiter(tally.keys(), np.int64, len(tally))
    values = np.log1p(np.fromiter(tally.values(), np.float64, len(tally)))
    if len(values):
        values /= np.sqrt(values @ values)
    shape = [WORD_BUCKETS + k * STEPS + _step(v, e) for k, (v, e) in enumerate(zip(statistics(text, words), STATISTICS.values()))]
    extra = sorted({FEATURES - 1 - _extra(n, v) % EXTRA_BUCKETS for n, v in (metadata or {}).items()})
    scale = 1 / np.sqrt(len(STATISTICS))
    return (
        np.concatenate([numbers, np.array(shape + extra, np.int64)]),
        np.concatenate([values, np.full(len(shape) + len(extra), scale)]).astype(np.float32),
    )


@dataclass(frozen=True)
class QualityModel:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    calibration: tuple[float, float]

    def raw(self, numbers: np.ndarray, values: np.ndarray) -> float:
        """Bias, weights, and all pairs by the sum-of-squares identity."""
        moved = self.factors[numbers] * values[:, None]
        total = moved.sum(axis=0)
        pairs = 0.5 * float(total @ total - np.einsum("ij,ij->", moved, moved))
        return self.bias + float(self.weights[numbers] @ values) + pairs

    def score(self, text: str | None, metadata: dict | None = None) -> float:
        slope, shift = self.calibration
        return float(_sigmoid(slope * self.raw(*features(text, metadata)) + shift))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def constant_model(share: float) -> QualityModel:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return QualityModel(float(np.log(share / (1 - share))), np.zeros(FEATURES), np.zeros((FEATURES, 1)), (1.0, 0.0))


def train(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    weight: np.ndarray,
    rank: int = 6,
    epochs: int = 12,
    rate: float = 0.15,
    decay: float = 2e-5,
    seed: int = 11,
) -> QualityModel:
    """Fit by stochastic gradient descent, each coordinate slowed by what it has moved.

    A fifth of the rows is left out; on it the raw score is turned into a probability.
    """
    random = np.random.default_rng(seed)
    order = random.permutation(len(labels))
    aside, used = order[: len(order) // 5], order[len(order) // 5 :]
    weights, factors = np.zeros(FEATURES), random.normal(0, 0.05, (FEATURES, rank))
    past_w, past_f = np.full(FEATURES, 1e-2), np.full((FEATURES, rank), 1e-2)
    bias = 0.0
    for _ in range(epochs):
        for at in random.permutation(used):
            numbers, values = rows[at]
            own = factors[numbers]
            moved = own * values[:, None]
            total = moved.sum(axis=0)
            raw = bias + weights[numbers] @ values + 0.5 * (total @ total - (moved * moved).sum())
            wrong = (_sigmoid(raw) - labels[at]) * weight[at]
            bias -= 0.01 * wrong
            grad = wrong * values + decay * weights[numbers]
            past_w[numbers] += grad * grad
            weights[numbers] -= rate * grad / np.sqrt(past_w[numbers])
            grad = wrong * values[:, None] * (total - moved) + decay * own
            past_f[numbers] += grad * grad
            factors[numbers] = own - rate * 0.5 * grad / np.sqrt(past_f[numbers])
    model = QualityModel(bias, weights, factors, (1.0, 0.0))
    if len(aside) < 20 or len(set(labels[aside].tolist())) < 2:
        return model
    raw = np.array([model.raw(*rows[at]) for at in aside])
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps for the two numbers, with a weak pull to (1, 0)
        p = _sigmoid(slope * raw + shift)
        w, gap = weight[aside], p - labels[aside]
        g = np.array([w @ (gap * raw) + (slope - 1), w @ gap + shift * 0.1])
        curve = w * p * (1 - p)
        h = np.array([[curve @ (raw * raw) + 1, curve @ raw], [curve @ raw, curve.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
    return QualityModel(bias, weights.astype(np.float32), factors.astype(np.float32), (float(slope), float(shift)))


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
    metadata: tuple[str, ...] = (),
    rows_per_label: int = ROWS_PER_LABEL,
) -> QualityModel:
    """Train on a bounded sample of ``labelled``: at most ``rows_per_label`` rows of each
    label.  Only their features, at most WORD_BUCKETS numbers each, come to the driver."""

    @F.arrow_udf("numbers array<int>, values array<float>")
    def extract(texts: pa.Array, extra: pa.Array) -> pa.Array:
        found = [features(t, m) for t, m in zip(texts.to_pylist(), extra.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([n.astype(np.int32) for n, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
            ["numbers", "values"],
        )

    known = labelled.where(F.col(label).isin(0, 1)).select(
        key, F.col(text).alias("text"), _metadata(metadata).alias("extra"), F.col(label).cast("int").alias("label")
    )
    counts = dict(known.groupBy("label").count().collect())
    total = sum(counts.values())
    if len(counts) < 2:
        return constant_model((counts.get(1, 0) + 0.5) / (total + 1))
    sample = bounded_sample(known, rows_per_label, key, "label")
    found = sample.select(key, "label", extract("text", "extra").alias("f")).select(key, "label", "f.*").toArrow()
    labels = found["label"].to_numpy()
    numbers, values = found["numbers"].combine_chunks(), found["values"].combine_chunks()
    rows = [(n.values.to_numpy().astype(np.int64), v.values.to_numpy()) for n, v in zip(numbers, values)]
    order = sorted(range(len(rows)), key=lambda at: (str(found[key][at].as_py()), len(rows[at][0]), labels[at]))
    drawn = {k: int((labels == k).sum()) for k in (0, 1)}
    # Sampling per label changes their shares; the weights restore them.
    weight = np.array([counts[k] / drawn[k] for k in (0, 1)])[labels] * len(labels) / total
    return train([rows[at] for at in order], labels[order].astype(np.float64), weight[order])


def _metadata(columns: tuple[str, ...]):
    """Metadata as one struct of scalars."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]) if columns else F.struct(F.lit(0).alias("none"))


def classify(
    docs: DataFrame, model: QualityModel, text: str = "text", metadata: tuple[str, ...] = (), threshold: float = 0.7
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 where the score reaches the threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array, extra: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(t.as_py(), m.as_py()) for t, m in zip(texts, extra)], pa.float64())

    run = run.asNondeterministic()
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), run(F.col(text).cast("string"), _metadata(metadata)).alias("score")
    )
    return packed.select(
        *[F.col("doc").getField(c).alias(c) for c in kept], "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def fit_on_documents(docs: DataFrame, labels: DataFrame) -> QualityModel:
    marks = labels.where(~held_out(4, 2)).select("doc_id", "quality")
    return fit(docs.select("doc_id", "text", "n_chars").join(marks, "doc_id"), metadata=("n_chars",))


@query("op3_score_quality")
def op3_score_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_on_documents(docs, table(spark, sf_dir, "labels"))
    scored = classify(docs.select("doc_id", "text", "n_chars"), model, metadata=("n_chars",))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")
