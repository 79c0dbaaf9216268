"""Byte-level BPE against the library that defines the results."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import catalog, tokens

SF = "/root/testdata/sf0.01"
NAMES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def reference(name):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "", " ", "  ", "a  b", "a \n b", "\n", " a", "a ", "it's we'll I'd", "\t\tx", "x\n y", "<|endoftext|>",
    "日本語のテキスト と漢字", "emoji 😀👨‍👩‍👧 x", "\u0000\u0001", "a b   c", "\x1c \x85  x", "é́", "ß" * 300, "x" * 5000,
    "1234567 89,10.5%", "###$$$%%%", "ﬁ ſecret K", "﻿bom", "‘quoted’ — dash…", " 's 't", "a\r\nb\r\n\r\n  c",
]


@pytest.mark.parametrize("name", NAMES)
def test_same_ids_as_library(name):
    codec, library = tokens.Codec(tokens.public_vocabulary(name)), reference(name)
    draw = random.Random(5)
    mixed = "ab cde 'sé9\n\t .,日😀-_" + " "
    for text in ODD + ["".join(draw.choices(mixed, k=draw.randrange(60))) for _ in range(2000)]:
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_query_against_library(spark):
    library = reference(NAMES[0])
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.QUERIES["op9_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_unusual_rows(spark):
    vocabulary = tokens.public_vocabulary()
    rows = [(1, None, "kept", "a"), (2, "", "kept", "b"), (2, "", "kept", "b"), (None, "word " * 50_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, `out.put` string")
    found = tokens.encode(docs, vocabulary)
    assert sorted(found.columns) == sorted(["doc_id", "text", "out.put", "ids", "decoded"])
    got = found.collect()
    assert [len(r.ids) for r in got[:3]] == [0, 0, 0] and bytes(got[0].decoded) == b""
    assert bytes(got[3].decoded) == b"word " * 50_000
    again = tokens.decode(found.drop("decoded"), vocabulary).collect()
    assert [bytes(r.decoded) for r in again] == [bytes(r.decoded) for r in got]
    assert tokens.encode(docs.limit(0), vocabulary).count() == 0


def test_vocabulary_needs_every_byte(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        tokens.Vocabulary.read(str(path), ".")
