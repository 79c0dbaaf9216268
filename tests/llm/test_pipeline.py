"""The corpus pipeline, stage by stage against plain versions."""

import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from millrace.llm import language, secrets, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of ``documents`` and of every stage's result, each stored and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append((name, docs))
    return out


def rows(stages, n):
    return stages[n][1].collect()


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "secret_scan", "mix_sources", "byte_bpe"]
    for name, docs in stages[:-1]:
        assert docs.columns == stages[0][1].columns, name


def test_language_drops_what_is_rejected(stages):
    model = language.fit_on_documents(stages[0][1])
    expected = [r.doc_id for r in rows(stages, 0) if not model.predict(r.text)[2]]
    assert sorted(r.doc_id for r in rows(stages, 1)) == sorted(expected)


def test_one_of_each_group_stays(stages):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    docs = sorted(rows(stages, 1), key=lambda r: r.doc_id)
    sets = [shingles(r.text or "") for r in docs]
    parent = list(range(len(docs)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                high, low = sorted((root(a), root(b)), reverse=True)
                parent[high] = low
    assert sorted(r.doc_id for r in rows(stages, 2)) == [docs[n].doc_id for n in range(len(docs)) if root(n) == n]


def test_secrets_are_gone_and_the_rest_is_not(stages):
    before, after = ({r.doc_id: r for r in rows(stages, n)} for n in (2, 3))
    assert before.keys() == after.keys()
    strong = [re.compile(secrets.KINDS[k].pattern) for k in secrets.STRONG[1:]]
    for doc, row in after.items():
        assert not any(p.search(row.text) for p in strong)
        if "[SECRET]" not in row.text:
            assert row.text == before[doc].text
        assert row.n_chars == len(row.text)


def test_mix_repeats_whole_documents(stages):
    before, after = rows(stages, 3), rows(stages, 4)
    count = Counter((r.doc_id, r.text) for r in after)
    assert set(count) <= {(r.doc_id, r.text) for r in before} and max(count.values()) <= 4
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert sum(map(size, after)) == pytest.approx(sum(map(size, before)), rel=0.1)


def test_tokens(stages):
    vocabulary = tokens.public_vocabulary()
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(zip(vocabulary.tokens, vocabulary.ids)), special_tokens={}
    )
    texts = {r.doc_id: r.text for r in rows(stages, 4)}
    for r in rows(stages, 5):
        assert r.round_trip and r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run_and_unusual_documents(spark, tmp_path):
    docs = [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", None, None, 0), (3, "### 12", "en", "a", 6), (4, "the cat sat", "en", "a", 11)]
    docs += [(5, "der hund und die katze " * 20_000, "de", None, 1), (6, "token=abcdef the dog", "en", "b", 20), (6, "token=abcdef the dog", "en", "b", 20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {4, 5, 6} and all(r.round_trip for r in found)
    frame.limit(0).write.mode("overwrite").parquet(str(tmp_path / "empty" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_stages_send_few_texts_at_a_time_to_python(spark):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, docs = spark.conf.get(option), spark.createDataFrame([(i, f"some words that differ {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    try:
        for held, expected in (("10000", 1000), ("0", 1000), ("200", 200)):
            spark.conf.set(option, held)
            kept = corpus_pipeline.jaccard_join(spark, docs, "")
            sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
            assert max(r["n"] for r in sizes) == expected and sum(r["n"] for r in sizes) == 3000
        assert kept.count() == 3000
    finally:
        spark.conf.set(option, usual)
