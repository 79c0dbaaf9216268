"""Repeated passages that lie over several lines or within sentences."""

import random
import re
from collections import defaultdict

from millrace.llm import catalog, passages


def _drawn(seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefghiklmno", k=6)) for _ in range(5000)]
    return lambda n: draw.choices(vocabulary, k=n)


def _covers(found, doc, text, part, kept):
    at = text.index(part)
    return any(r.doc_id == doc and r.begin <= at and at + len(part) <= r.finish and r.kept == kept for r in found)


def test_passage_over_short_lines(spark):
    words = _drawn(5)
    lines = [" ".join(words(n)) for n in (24, 31, 20, 28)]
    passage, blanks = "\n".join(lines), "\n \n".join(lines)
    changed = " ".join(lines[1].split()[:15] + ["other"] + lines[1].split()[16:])
    near = "\n".join([lines[0], changed, *lines[2:]])
    own = lambda: " ".join(words(40)) + "."
    docs = [(1, f"{own()}\n{passage}\n{own()}"), (2, blanks), (3, f"{own()}\n{near}"), (4, f"{own()}\n{own()}")]
    found = passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for doc, part in ((1, passage), (2, blanks), (3, near)):
        assert _covers(found, doc, docs[doc - 1][1], part, doc == 1)
    assert {r.doc_id for r in found} == {1, 2, 3} and {r.class_id for r in found} == {1}


def _runs(docs, words=50):
    """Per document the words of runs that are equal in several: as (begin, finish)."""
    seen, spans = defaultdict(set), {}
    for doc, text in docs:
        tokens = text.lower().split()
        spans[doc] = [m.span() for m in re.finditer(r"\S+", text)]
        for i in range(len(tokens) - words + 1):
            seen[tuple(tokens[i : i + words])].add(doc)
    for doc, text in docs:
        tokens, hit = text.lower().split(), set()
        for i in range(len(tokens) - words + 1):
            if len(seen[tuple(tokens[i : i + words])]) > 1:
                hit.update(range(i, i + words))
        yield doc, [spans[doc][i] for i in sorted(hit)]


def test_runs_without_sentences(spark):
    words = _drawn(6)
    hot, stops = words(57), "Some sentence of five words. " * 30
    docs = []
    for n in range(60):  # from the middle of a line, without stops, and cut to other lengths
        part = hot[n % 5 : len(hot) - n % 3] if n % 2 else words(51)
        docs.append((n, " ".join(words(n) + part[: 51 + n % 7] + words(70 - n))))
    docs += [(60, " ".join(hot[:50])), (61, " ".join(hot[:49])), (62, stops + "x " + stops), (63, "y " + stops)]
    found = passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    reported = defaultdict(list)
    for r in found:
        reported[r.doc_id].append((r.begin, r.finish))
    hits = 0
    for doc, places in _runs(docs):
        covered = [s for s in (m.span() for m in re.finditer(r"\S+", dict(docs)[doc])) if any(b <= s[0] and s[1] <= f for b, f in reported[doc])]
        if doc < 61:  # one line each: no near copies but whole ones, which are drawn apart
            assert covered == places, doc
        else:
            assert set(places) <= set(covered), doc
        hits += bool(places)
    assert hits >= 33 and not reported[61]


def test_query_covers_all_equal_runs(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    reported = defaultdict(list)
    for r in catalog.QUERIES["op7_repeated_passages"](spark, sf).collect():
        reported[r.doc_id].append((r.begin, r.finish))
    for doc, places in _runs(docs):
        assert all(any(b <= s and e <= f for b, f in reported[doc]) for s, e in places), doc
