"""Quality scores: held-out accuracy, the linear-time identity, unusual rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import catalog, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    return quality.fit_on_documents(read("documents"), read("labels"))


def test_pairs_equal_the_double_sum():
    random = np.random.default_rng(1)
    model = quality.QualityModel(0.3, random.normal(size=quality.FEATURES), random.normal(size=(quality.FEATURES, 4)), (1.0, 0.0))
    numbers, values = np.array([3, 70, 900, 16400]), np.array([0.5, 0.1, 0.7, 0.2])
    pairs = sum(
        model.factors[numbers[i]] @ model.factors[numbers[j]] * values[i] * values[j] for i, j in itertools.combinations(range(4), 2)
    )
    assert model.raw(numbers, values) == pytest.approx(0.3 + model.weights[numbers] @ values + pairs)


def test_held_out_accuracy(spark):
    found = catalog.QUERIES["op3_score_quality"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_are_not_read(spark, model):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit_on_documents(docs, flipped)
    assert again.score("The words of a text.", {"n_chars": 20}) == model.score("The words of a text.", {"n_chars": 20})


def test_unusual_rows(spark, model):
    rows = [(1, None, None, 1.5), (2, "", 0, 1.5), (3, "| | |", 5, 1.5), (4, "word " * 200_000, 10**6, None), (4, "word " * 200_000, 10**6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score double")
    found = quality.classify(docs, model, metadata=("n_chars",)).collect()
    assert all(0 <= r.score <= 1 for r in found) and found[3] == found[4]
    same = quality.classify(docs, model).collect()
    assert same[0].score == same[1].score
    assert quality.classify(docs.limit(0), model).count() == 0


def test_one_label_only(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "doc_id long, text string, quality int")
    assert quality.fit(docs).score("c") == pytest.approx(0.75)
    assert quality.fit(docs.limit(0)).score("c") == pytest.approx(0.5, abs=1e-6)


def test_scores_against_plain_version(spark, model):
    """Bias, weights, the double sum over pairs of features and the sigmoid, one by one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars").orderBy("doc_id").limit(60)
    got = {r.doc_id: r.score for r in quality.classify(docs, model, metadata=("n_chars",)).collect()}
    for row in docs.collect():
        numbers, values = quality.features((row.text or "")[:20_000], {"n_chars": row.n_chars})
        if len(row.text or "") > 20_000 or len(numbers) > 400:
            continue
        raw = model.bias + sum(float(model.weights[i]) * float(v) for i, v in zip(numbers, values))
        for (i, a), (j, b) in itertools.combinations(list(zip(numbers, values)), 2):
            raw += float(model.factors[i] @ model.factors[j]) * float(a) * float(b)
        slope, shift = model.calibration
        assert got[row.doc_id] == pytest.approx(1 / (1 + np.exp(-(slope * raw + shift))), abs=1e-4)


def test_infinite_null_and_repeated_metadata(spark, model):
    rows = [(1, "some words here", float("inf")), (1, "some words here", float("-inf")), (None, "some words here", float("nan")), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars double")
    found = [r.score for r in quality.classify(docs, model, metadata=("n_chars",)).collect()]
    assert found[0] == found[1] == found[2] and all(0 <= s <= 1 for s in found)
    labelled = docs.selectExpr("*", "1 AS quality").unionByName(docs.selectExpr("*", "0 AS quality"))
    assert 0 <= quality.fit(labelled, metadata=("n_chars",)).score("words") <= 1
