"""Language identification: held-out accuracy and unusual rows."""

import numpy as np
import pytest

from millrace.llm import catalog, language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit_on_documents(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = catalog.QUERIES["op2_identify_language"](spark, SF)
    rows = found.join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score", "rejected").collect()
    assert found.count() == docs.count()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_ignores_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(language.held_out(5, 0), F.lit("xx")).otherwise(F.col("lang")))
    assert language.fit_on_documents(changed).languages == language.fit_on_documents(docs).languages


def test_subwords_stay_inside_words():
    a = set(language.subword_buckets("der hund").tolist())
    assert a == set(language.subword_buckets("  HUND,  der ").tolist())
    assert len(language.subword_buckets("12 ## ,")) == 0
    long = "der hund " * 60_000
    assert len(language.subword_buckets(long)) > 500_000


def test_unusual_rows(spark, model):
    rows = [(1, None, 5), (2, "", 5), (3, "12 %", 5), (4, "ein " * 200_000, 5), (4, "ein " * 200_000, 5), (None, "le", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = language.identify(docs, model).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in found[:3]] == [("und", 0.0, True)] * 3
    assert found[3] == found[4] and found[3].lang_pred in model.languages
    assert found[5].lang_pred in model.languages
    assert language.identify(docs.limit(0), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "der", None)], "doc_id long, text string, lang string")
    found = language.identify(docs, language.fit(docs)).first()
    assert (found.lang_pred, found.rejected) == ("und", True)


def plain_subwords(text):
    """Buckets of the subwords of a text by plain loops, with the piece of each."""
    kept, letters = [" "], [c if c.isalpha() else " " for c in text.lower()]
    for c in [*letters, " "]:
        if c != " " or kept[-1] != " ":
            kept.append(c)
    out = []
    for n in (2, 3, 4):
        for at in range(len(kept) - n + 1):
            gram = kept[at : at + n]
            if " " in gram[1:-1] or set(gram) == {" "}:
                continue
            hashed = n * 0x85EBCA6B & 0xFFFFFFFF
            for c in gram:
                hashed = (hashed + ord(c)) * 0x9E3779B1 & 0xFFFFFFFF
                hashed ^= hashed >> 15
            out.append((hashed >> (32 - language.BITS), at // language.PIECE))
    return out


def plain_prediction(model, text):
    found = plain_subwords(text)

    def logits(buckets):
        return [sum(float(model.table[b, k]) for b in buckets) / len(buckets) + float(model.bias[k]) for k in range(len(model.languages))]

    def shares(buckets):
        factor = np.exp(model.scale[0] + model.scale[1] * np.log(1 + len(buckets)))
        raised = [np.exp(factor * (x - max(logits(buckets)))) for x in logits(buckets)]
        return [x / sum(raised) for x in raised]

    whole = shares([b for b, _ in found])
    known = 0
    sizes, least = zip(*model.thresholds)
    for piece in {p for _, p in found}:
        own = [b for b, p in found if p == piece]
        second, top = sorted(logits(own))[-2:]
        known += len(own) * (top - second >= np.interp(np.log(len(own)), np.log(sizes), least))
    best = max(range(len(whole)), key=lambda k: whole[k])
    return model.languages[best], whole[best], 2 * known < len(found)


def test_predictions_against_plain_version(spark, model):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect() if r.text]
    texts += [a[:300] + " " + b[:500] for a, b in zip(texts[:40], texts[40:80])] + ["Ab", "a b c 1 d", "日本 x"]
    for text in texts:
        if any(map(str.isalpha, text)):
            name, score, rejected = model.predict(text[:6000])
            expected = plain_prediction(model, text[:6000])
            assert (name, rejected) == (expected[0], expected[2]) and score == pytest.approx(expected[1], abs=1e-6)


STRANGE = {
    "japanese": "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。" * 4,
    "cyrillic": "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 6,
    "greek": "Άνδρα μοι έννεπε, Μούσα, πολύτροπον, ος μάλα πολλά πλάγχθη, επεί Τροίης ιερόν πτολίεθρον έπερσε. " * 6,
    "code": "#include <stdio.h>\nint main(void) { for (int i = 0; i < n; ++i) { buf[i] ^= key[i % klen]; printf(\"%02x\", buf[i]); } return 0x7f; }\n" * 6,
}


def test_strange_texts_are_rejected_and_clean_and_mixed_ones_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.fit_on_documents(docs)
    held = docs.where(language.held_out(5, 0)).select("text").collect()
    assert np.mean([model.predict(r.text)[2] for r in held]) < 0.01
    assert {name: model.predict(text)[2] for name, text in STRANGE.items()} == dict.fromkeys(STRANGE, True)
    by_lang = {}
    for r in docs.where("length(text) > 400").orderBy("doc_id").limit(800).select("text", "lang").collect():
        by_lang.setdefault(r.lang, []).append(r.text)
    names = sorted(k for k in by_lang if k is not None)
    mixed = [" ".join(by_lang[k][i % len(by_lang[k])][:400] for k in names) for i in range(60)]
    assert np.mean([model.predict(text)[2] for text in mixed]) < 0.02
