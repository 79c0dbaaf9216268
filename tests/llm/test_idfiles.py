"""Files of token ids: round trips, the library's own ids, reads from the middle."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import catalog, idfiles, repair

SF = "/root/testdata/sf0.01"


def sequences():
    draw = np.random.default_rng(5)
    phrase = draw.integers(0, 90, 300)
    yield np.zeros(0, np.uint32)
    yield np.array([7], np.uint32)
    yield np.zeros(1000, np.uint32)
    yield np.tile([1, 2], 501)
    yield np.tile([3, 3, 3, 4], 333)
    yield draw.integers(0, 100, 5000)
    yield np.concatenate([np.r_[phrase[: draw.integers(1, 300)], draw.integers(0, 100, 3)] for _ in range(200)])
    yield np.repeat(draw.integers(0, 5, 700), draw.integers(1, 9, 700))


@pytest.mark.parametrize("number", range(8))
def test_grammar_round_trip_and_spans(number):
    ids = list(sequences())[number].astype(np.uint32)
    grammar = repair.compress(ids, 100)
    assert (grammar.expand() == ids).all() and len(grammar.expand()) == len(ids)
    assert len(grammar.symbols) <= len(ids)
    draw = random.Random(number)
    for _ in range(50):
        a, b = sorted(draw.choices(range(len(ids) + 1), k=2))
        assert (grammar.span(a, b) == ids[a:b]).all() and len(grammar.span(a, b)) == b - a
    for k, (a, b) in enumerate(grammar.rules.tolist()):
        assert max(a, b) < 100 + k
        assert grammar.lengths[k] == grammar.all_lengths[a] + grammar.all_lengths[b]
    lengths = np.array([len(ids)])
    again = repair.Shard.from_bytes(repair.Shard(grammar, np.array([5]), np.array([0]), lengths).to_bytes())
    assert (again.grammar.expand() == ids).all() and again.docs.tolist() == [5]


def test_every_pair_left_is_rare():
    ids = np.random.default_rng(1).integers(0, 40, 20_000).astype(np.uint32)
    grammar = repair.compress(ids, 40, gain=0)
    left = list(zip(grammar.symbols[:-1].tolist(), grammar.symbols[1:].tolist()))
    uses = {}
    at = 0
    while at < len(left):
        uses[left[at]] = uses.get(left[at], 0) + 1
        at += 1
    runs = {pair for pair in uses if pair[0] == pair[1]}
    assert max((n for pair, n in uses.items() if pair not in runs), default=0) < repair.LEAST_USES
    assert len({tuple(r) for r in grammar.rules.tolist()}) == len(grammar.rules)
    assert len(grammar.symbols) + 3 * len(grammar.rules) < len(ids)


def test_widths_and_damage():
    for first in (60_000, 1 << 20, (1 << 24) + 5):
        ids = np.array([first - 1, 0, 5] * 50, np.uint32)
        shard = repair.Shard(repair.compress(ids, first), np.array([1]), np.array([0]), np.array([150]))
        assert (repair.Shard.from_bytes(shard.to_bytes()).grammar.expand() == ids).all()
    with pytest.raises(ValueError):
        repair.Shard.from_bytes(b"\0" * 100)
    with pytest.raises(ValueError):
        repair.compress(np.array([9], np.uint32), 9)


ODD = [
    "", " ", "  ", "a  b", "a \n b", "\n", " a", "a ", "it's we'll I'd", "\t\tx", "x\n y", "x <|endoftext|> y", "日本語のテキスト と漢字",
    "emoji 😀👨‍👩‍👧 x", "\u0000\u0001", "a b　 c", "\x1c \x85  x \x1f\x1e", "é", "ß" * 300, "x" * 3000, "1234567 89,10.5% ½ ²", "###$$$%%%",
    "﻿bom", "‘quoted’ — dash…", " 's 't", "a\r\nb\r\n\r\n  c", "​⁠ ᠎ x", "Ⅷ ① ٣ ߀", "new letters \U000323b0\u0558\ua7cf x",
]


def test_same_ids_as_library():
    definition = idfiles.public_definition()
    library, encoder = Tokenizer.from_str(definition), idfiles.Encoder(definition, memory=500)
    draw = random.Random(5)
    mixed = "ab cde 'sé9\n\t .,日😀-_  "
    texts = ODD + ["".join(draw.choices(mixed, k=draw.randrange(60))) for _ in range(2000)]
    for start in range(0, len(texts), 97):
        part = texts[start : start + 97]
        expected = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [ids.tolist() for ids in encoder.encode(part)] == expected
    assert encoder.encode([]) == []


def test_every_character_splits_as_in_library():
    splitter = Tokenizer.from_str(idfiles.public_definition()).pre_tokenizer
    kinds = idfiles.character_kinds()
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and kinds[c] != idfiles.UNKNOWN]
    assert len(characters) > 280_000
    for start in range(0, len(characters), 4096):
        texts = ["".join(f"a{c}1{c}.{c}{c} {c}'{c}s" for c in characters[start : start + 2048]), "".join(characters[start + 2048 : start + 4096])]
        texts = [text for text in texts if text]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *[len(text) for text in texts]])[:-1]
        expected = [at + begin for at, text in zip(starts, texts) for _, (begin, _) in splitter.pre_tokenize_str(text)]
        assert idfiles.split_places(codes, starts).tolist() == expected


def test_random_texts_split_as_in_library():
    splitter = Tokenizer.from_str(idfiles.public_definition()).pre_tokenizer
    draw = random.Random(8)
    for _ in range(300):
        texts = ["".join(draw.choices("  \n\t" + "'" * 3 + "sstrvemld1é.-", k=draw.randrange(1, 12))) for _ in range(20)]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *[len(text) for text in texts]])[:-1]
        expected = [at + begin for at, text in zip(starts, texts) for _, (begin, _) in splitter.pre_tokenize_str(text)]
        assert idfiles.split_places(codes, starts).tolist() == expected


def test_query_against_library(spark):
    library = Tokenizer.from_str(idfiles.public_definition())
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = sorted(tuple(r) for r in catalog.QUERIES["op13_id_files"](spark, SF).collect())
    start = 0
    assert len(rows) == len(docs)
    for (doc, text), row in zip(docs, rows):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert row == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_unusual_rows_and_spans(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["alpha", "beta", "gamma", "delta"], k=draw.randrange(200))), "x") for i in range(60)]
    rows += [(None, "null id", "y"), (None, None, "y"), (3, None, None), (3, None, None), (70, "word " * 30_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string").repartition(7)
    path = str(tmp_path / "files")
    idfiles.write_files(docs, path, idfiles.public_definition(), files=5, shard_ids=700)
    library = Tokenizer.from_str(idfiles.public_definition())
    expected = sorted((-1 if i is None else i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in rows)
    found = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in idfiles.read_files(spark, path).orderBy("start").collect()]
    assert sorted((-1 if i is None else i, tuple(ids)) for i, _, ids in found) == expected
    assert [i for i, _, _ in found] == sorted([i for i, _, _ in found], key=lambda i: -1 if i is None else i)
    whole = [x for _, _, ids in found for x in ids]
    assert [s for _, s, _ in found] == np.cumsum([0, *[len(ids) for _, _, ids in found]])[:-1].tolist()
    assert idfiles.shards(spark, path).count() > 10
    spans = [(k, draw.randrange(len(whole)), draw.randrange(1, 3000)) for k in range(30)] + [(30, len(whole) + 5, 10), (31, 0, len(whole)), (32, 4, 0)]
    parts = idfiles.read_spans(spark, path, spark.createDataFrame(spans, "span long, begin long, length long"), cell=512).orderBy("span", "start").collect()
    for k, begin, length in spans:
        got = [x for r in parts if r.span == k for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert got == whole[begin : begin + length]
    empty = str(tmp_path / "empty")
    idfiles.write_files(docs.limit(0), empty, idfiles.public_definition())
    assert idfiles.read_files(spark, empty).count() == 0


def test_parts_of_one_slot_or_one_hash(monkeypatch):
    """Hashes that say too little: every part still gets its own ids."""
    definition = idfiles.public_definition()
    library, hashes = Tokenizer.from_str(definition), idfiles.part_hashes
    texts = ["one two three two one five six", "seven one " + "y" * 300 + " two", "three ten" * 40]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for narrow in (lambda h: h & np.uint64(3), lambda h: h % np.uint64(5) << np.uint64(60)):
        monkeypatch.setattr(idfiles, "part_hashes", lambda *a, n=narrow: (n(hashes(*a)[0]), hashes(*a)[1]))  # noqa: B023
        encoder = idfiles.Encoder(definition)
        for _ in range(3):
            assert [ids.tolist() for ids in encoder.encode(texts)] == expected
