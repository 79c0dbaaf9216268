"""Repeated passages against a plain version on whole tables."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from millrace.llm import catalog, jaccard, passages, scratch

SF = "/root/testdata/sf0.001"


def units_of(lines, words):
    """Lines (as ranges of words) with enough words, and of neighbouring shorter ones from
    each on, and from each back, the fewest that have enough together."""
    found, group = set(), []
    for line in [*lines, None]:
        if line is not None and line[1] - line[0] < words:
            group.append(line)
            continue
        for i in range(len(group)):
            on = next((j for j in range(i, len(group)) if group[j][1] - group[i][0] >= words), None)
            back = next((j for j in range(i, -1, -1) if group[i][1] - group[j][0] >= words), None)
            found |= {(group[i][0], group[on][1])} if on is not None else set()
            found |= {(group[back][0], group[i][1])} if back is not None else set()
        group = []
        if line is not None:
            found.add(line)
    return sorted(found)


def brute(docs, words=50, threshold=0.8):
    """(doc_id, begin, finish, class_id, kept) of all documents: by all runs of words, and
    by all pairs of lines.  A document is a row; ids may repeat."""
    units, runs = [], defaultdict(list)
    for row, (_, text) in enumerate(docs):
        spans = [m.span() for m in re.finditer(r"\S+", text or "")]
        tokens = (text or "").lower().split()
        assert len(tokens) == len(spans)
        line_of = [(text or "").count("\n", 0, start) for start, _ in spans]
        cuts = [0, *[i for i in range(1, len(spans)) if line_of[i] != line_of[i - 1]], len(spans)] if spans else []
        for start, end in units_of(list(zip(cuts, cuts[1:])), words):
            units.append((row, spans[start][0], spans[end - 1][1], {tuple(tokens[i : i + 5]) for i in range(start, end - 4)}))
        for i in range(len(tokens) - words + 1):
            runs[tuple(tokens[i : i + words])].append((row, spans[i][0], spans[i + words - 1][1]))
    parent = list(range(len(units)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    holding = defaultdict(set)
    for n, unit in enumerate(units):
        for shingle in unit[3]:
            holding[shingle].add(n)
    for a in range(len(units)):
        for b in {b for shingle in units[a][3] for b in holding[shingle] if b < a}:
            common = len(units[a][3] & units[b][3])
            if common >= threshold * (len(units[a][3]) + len(units[b][3]) - common) - 1e-9:
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for n, unit in enumerate(units):
        classes[root(n)].append(unit[:3])
    # Rows of one id and text are in no order of their own: the first stands for them.
    order = lambda row: (docs[row][0] is None, docs[row][0] or 0, hashlib.md5((docs[row][1] or "").encode()).digest(), row)
    hits = defaultdict(set)
    for members in [*classes.values(), *runs.values()]:
        if len({m[0] for m in members}) > 1:
            first = min((order(row), begin) for row, begin, _ in members)
            for row, begin, finish in members:
                hits[row, (order(row), begin) == first].add((begin, finish, docs[first[0][3]][0]))
    out = []
    for (row, kept), spans in hits.items():
        open_span, doc = None, docs[row][0]
        for begin, finish, first in sorted(spans):
            if open_span and begin <= open_span[1]:
                open_span = [open_span[0], max(open_span[1], finish), min(open_span[2], first)]
            else:
                if open_span:
                    out.append((doc, *open_span, kept))
                open_span = [begin, finish, first]
        out.append((doc, *open_span, kept))
    return sorted(out)


def got(frame):
    return sorted((r.doc_id, r.begin, r.finish, r.class_id, r.kept) for r in frame.collect())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = brute(docs)
    assert got(catalog.QUERIES["op7_repeated_passages"](spark, SF)) == expected and len(expected) > 20


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghiklmno", k=5)) for _ in range(3000)]
    sentence = lambda n: " ".join(draw.choices(vocabulary, k=n)).capitalize() + "."
    hot = " ".join(sentence(12) for _ in range(5))
    docs = []
    for n in range(90):
        lines = [" ".join(sentence(draw.randrange(4, 15)) for _ in range(draw.randrange(1, 9))) for _ in range(3)]
        if n % 3 == 0:  # a passage in a third of the documents, within a longer line
            lines[1] = lines[1] + " " + hot + " " + sentence(9)
        elif n % 3 == 1:  # the same as a line of its own, one word changed
            words = hot.split()
            words[draw.randrange(len(words))] = "é😀"
            lines.insert(draw.randrange(3), " ".join(words))
        docs.append((n, "\n".join(lines)))
    return docs


def test_hot_passage_in_blocks(spark, planted, monkeypatch):
    monkeypatch.setattr(passages.PassageSettings, "join", property(lambda s: passages.JoinSettings(sketch=s.bands * s.rows, bucket=8)))
    frame = spark.createDataFrame(planted, "doc_id long, text string").repartition(5)
    found = got(passages.repeated_passages(frame))
    assert found == brute(planted)
    assert {n for n in range(90) if n % 3 == 0} <= {r[0] for r in found} <= {n for n in range(90) if n % 3 < 2}


def test_random_texts_against_brute_force(spark):
    """Short and long lines, passages cut at random and changed a little, equal texts."""
    for seed in (1,):
        draw = random.Random(seed)
        vocabulary = ["".join(draw.choices("abcdefghiklmno", k=4)) for _ in range(400)]
        stock = [draw.choices(vocabulary, k=draw.randrange(55, 140)) for _ in range(6)]
        docs = []
        for n in range(70):
            words = []
            for _ in range(draw.randrange(1, 5)):
                part = list(draw.choice(stock))
                cut = part[draw.randrange(len(part) // 2) :][: draw.randrange(30, 120)]
                if draw.random() < 0.4:
                    cut[draw.randrange(len(cut))] = "Changed"
                words += draw.choices(vocabulary, k=draw.randrange(25)) + cut
            line = draw.choice([9, 15, 30, 60, 500])
            docs.append((n, "\n".join(" ".join(words[i : i + line]) for i in range(0, len(words), line))))
        docs += [(200 + i, docs[i % 9][1]) for i in range(30)]
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
        expected = brute(docs)
        assert got(passages.repeated_passages(frame)) == expected and len(expected) > 100


def cut(text, spans):
    for begin, finish in sorted(spans, reverse=True):
        text = text[:begin] + text[finish:]
    return text


def test_cut_texts(spark, planted):
    frame = spark.createDataFrame([(i, t, 7) for i, t in planted], "doc_id long, text string, begin int")
    removed = defaultdict(list)
    for doc, begin, finish, _, kept in brute(planted):
        if not kept:
            removed[doc].append((begin, finish))
    for row in passages.without_repeats(frame).collect():
        assert row.text == cut(dict(planted)[row.doc_id], removed[row.doc_id]) and row.begin == 7


def test_repeated_ids_are_cut_apart(spark, planted):
    """One id for all, clashing columns, and rows equal in id and text: one of them stays."""
    texts = [t for _, t in planted[:12]] + [planted[0][1], "no repeat here", None]
    frame = spark.createDataFrame([(2, t, n, "x") for n, t in enumerate(texts)], "doc_id long, text string, row int, kept string").repartition(4)
    rows = passages.without_repeats(frame).collect()
    assert sorted(r.row for r in rows) == list(range(15)) and {r.kept for r in rows} == {"x"}
    by_row = {r.row: r.text for r in rows}
    assert by_row[13] == "no repeat here" and by_row[14] is None
    # Of the equal rows 0 and 12 one is cut to nothing but what stands between passages.
    docs = [(2, t) for t in texts]
    wanted = defaultdict(list)
    for _, begin, finish, _, kept in brute(docs):
        if not kept:
            wanted["all"].append((begin, finish))
    assert len({by_row[0], by_row[12]}) == 2
    longer = [t for t in (by_row[0], by_row[12])]
    assert sum(len(t) for t in longer) < 2 * len(texts[0])


def test_unusual_rows(spark):
    long = "Word other. " * 40_000
    rows = [(1, None), (2, ""), (3, " \n\n "), (4, "short line"), (5, long), (6, long), (6, long), (None, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id or 99), r.begin, r.finish, r.class_id, r.kept) for r in passages.repeated_passages(frame).collect())
    size = len(long.rstrip())
    assert (5, 0, size, 5, True) in found and found.count((6, 0, size, 5, False)) == 2
    assert {f[0] for f in found} == {5, 6, 99} and all(f[3] == 5 for f in found)
    assert passages.repeated_passages(frame.limit(0)).count() == 0
    assert passages.repeated_passages(frame.where("doc_id < 5")).count() == 0


def test_tables_go_once_they_are_read(spark, planted, monkeypatch):
    live, store = {}, scratch.Scratch.store

    def noted(self, df, label):
        live[label] = set(self.paths)
        return store(self, df, label)

    monkeypatch.setattr(scratch.Scratch, "store", noted)
    passages.repeated_passages(spark.createDataFrame(planted[:12], "doc_id int, text string"))
    assert live["spans"] == {"rows", "copied-texts", "equal-runs", "near-lines"}
    assert not live["near-lines"] & {"band-sizes", "likely-lines", "wanted-lines", "line-shingles"}


def test_sketches_of_all_runs_at_once():
    text = "a b c d e f g h İ j\nk l m n o p q r s t\nab ab ab ab ab ab ab\n" * 9
    words = passages._Words(text)
    units = words.units(12)
    sets = words.shingle_sets(units)
    plain = [sorted({tuple(text.lower().split()[i : i + 5]) for i in range(start, end - 4)}) for start, end in units]
    assert len(units) > 9 and [len(found) for found in sets] == [len(found) for found in plain]
    assert (words.sketches(units, sets, 30) == [passages.minima(found, 30) for found in sets]).all()
    assert words.hashes[8] != words.hashes[9] and (words.hashes[:27] == words.hashes[27:54]).all()


def test_pairs_of_many_tasks_at_once():
    draw, settings = random.Random(4), jaccard.JoinSettings(sketch=16, slack=2)
    rows = []
    for key in range(60):
        cut = key % 3 == 0
        for n in range(draw.randrange(1, 12)):
            sketch = bytes(draw.choice([1, 1, 1, 1, 2]) for _ in range(16))
            keys = sorted({key, *draw.choices(range(60), k=draw.randrange(3))})
            rows.append({"key": key, "left": 0, "right": int(cut), "block": draw.randrange(2) if cut else 0, "size": draw.randrange(40, 60), "sketch": sketch, "keys": keys})
    groups = jaccard.pa.Table.from_pylist(rows)
    ends = [max(n for n, row in enumerate(rows) if row["key"] == own["key"]) + 1 for own in rows]

    def likely(x, y):
        sizes, same = sorted([x["size"], y["size"]]), sum(a == b for a, b in zip(x["sketch"], y["sketch"]))
        meet = x["key"] == y["key"] == min({*x["keys"]} & {*y["keys"]}, default=None)
        apart = x["left"] == x["right"] or x["block"] != y["block"]
        return meet and apart and sizes[0] >= settings.threshold * sizes[1] and same >= settings.least_matches

    expected = {(a, b) for b in range(len(rows)) for a in range(b) if likely(rows[a], rows[b])}
    assert set(jaccard._likely_pairs(groups, jaccard.np.array(ends), settings)) == expected and len(expected) > 20
