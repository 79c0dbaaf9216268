"""Spelling variants against a plain version that compares every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import spelling


def plain_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in spelling.UPPER else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(words):
    forms, near = {}, {}
    for a, n in words.items():
        around = [b for b in words if one_edit(a, b)]
        best = min(around, key=lambda b: (-words[b], b), default=None)
        forms[a] = best if best is not None and words[best] >= 10 * n else None
        near[a] = len(around)
    out = set()
    for a, n in words.items():
        root = a
        while forms[root] is not None:
            root = forms[root]
        out.add((a, n, near[a], forms[a], words.get(forms[a]), root))
    return out


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(7)
    letters = "abcdeéßÿ×ÀZQ"
    stems = ["".join(draw.choices(letters, k=draw.randrange(6, 12))) for _ in range(40)]
    texts = []
    for i in range(300):
        words = []
        for _ in range(60):
            word = stems[int(draw.random() ** 4 * len(stems))]
            while draw.random() < 0.2:
                at = draw.randrange(len(word) + 1)
                word = draw.choice([word[:at] + draw.choice(letters) + word[at:], word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at + 1 :]])
            words.append(word)
        texts.append((i // 2, draw.choice([" ", "-", "5", "\n", "日"]).join(words)))
    long = "".join(draw.choices(letters, k=20_000))
    texts += [(None, None), (7, ""), (None, long + " abcdefgh abcdefgh"), (None, long + "c"), (None, long), (None, long + "c"), (9, "x1 2")]
    return texts


def test_against_every_pair(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    found = spelling.corpus_words(docs)
    words = plain_words(planted)
    assert {(r.word, r.n) for r in found.collect()} == set(words.items())
    rows = [tuple(r) for r in spelling.variants(found).collect()]
    expected = plain_variants(words)
    assert len(rows) == len(expected) and set(rows) == expected
    assert sum(r[3] is not None for r in expected) > 50 and any(r[3] not in (None, r[5]) for r in expected)


def test_neighbourhood_is_whole():
    draw = random.Random(3)
    for symbols in (3, 5, 9):
        for length in (1, 2, 7, 12):
            word = "".join(draw.choices("abcdefghéÿ", k=length))
            codes = np.array([[ord(c) for c in word]], np.uint32)
            own, keys = spelling.neighbourhood(codes, symbols)
            values = [int(v) for v in spelling.symbol_values(symbols)]
            reduced = [values[ord(c)] for c in word]
            alphabet = [int(v) for v in spelling._values(symbols)]
            expected = {tuple(reduced[:i] + reduced[i + 1 :]) for i in range(length)}
            expected |= {tuple(reduced[:i] + [c] + reduced[i + 1 :]) for i in range(length) for c in alphabet}
            expected |= {tuple(reduced[:i] + [c] + reduced[i:]) for i in range(length + 1) for c in alphabet}

            def hashed(symbols):
                total = 0
                for value in symbols:
                    total = (total * spelling.BASE + value) & spelling.MASK
                return total

            assert {int(k) for k in keys[0]} == {hashed(s) for s in expected}
            assert int(own[0]) == hashed(reduced)


def test_ties_chains_and_empty_tables(spark):
    words = spark.createDataFrame(
        [("aaaaaaa", 1000), ("aaaaaab", 100), ("aaaaacb", 10), ("baaaaaa", 1000), ("zzzzzzz", 5), ("zzzzzzy", 50), ("zzzzzzx", 50), ("zzzzzzw", 6)], "word string, n long"
    )
    found = {r.word: (r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(words).collect()}
    assert found["aaaaacb"] == (1, "aaaaaab", 100, "aaaaaaa")
    assert found["aaaaaab"] == (2, "aaaaaaa", 1000, "aaaaaaa")
    assert found["baaaaaa"] == (1, None, None, "baaaaaa")
    assert found["zzzzzzz"] == (3, "zzzzzzx", 50, "zzzzzzx")
    assert found["zzzzzzw"] == (3, None, None, "zzzzzzw")
    docs = spark.createDataFrame([], "doc_id long, text string, word string, n int")
    assert spelling.variants(spelling.corpus_words(docs)).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "lettered lettered", "x", 3), (1, "letterd letterd", "y", 4)], "doc_id long, text string, word string, run int")
    found = {r.word: r.n for r in spelling.corpus_words(docs).collect()}
    assert found == plain_words([(1, "lettered lettered"), (1, "letterd letterd")])
