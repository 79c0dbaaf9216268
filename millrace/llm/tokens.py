"""Byte-level BPE encoding and decoding with a sentencepiece model made from the ranks.

The rank file is turned into a sentencepiece BPE model as it stands, without training:
every token is a piece, its bytes mapped one to one to characters, and its score is the
negative rank, so that the library merges what the ranks merge first.  Normalisation is
the identity and no prefix is added.  Text is cut by the pre-token pattern, every match
is encoded on its own, and a match that is itself a token is that token.  Decoding joins
the bytes of the ids.

Defined results for unusual rows: a null text is encoded as an empty one (no ids, empty
bytes); texts of any length are encoded whole; repeated rows give repeated results; an
empty table gives an empty result; columns of the input are kept, the added columns
replace those of the same name.  Decoding a null list of ids gives null.
"""

from __future__ import annotations

import base64
import codecs
import functools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import query, table

# Entries of a worker's memory of encoded words; above that it is emptied between slices.
MEMORY = 100_000
# Bytes of text that are encoded at a time.
SLICE = 2_000_000

# Characters that stand for the 256 bytes: a contiguous range without white space.
FIRST_CHARACTER = 0x100

ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())])


def _varint(number: int) -> bytes:
    out = bytearray()
    number &= (1 << 64) - 1
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One field in the wire format of the model file."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


CHARACTERS = "".join(chr(FIRST_CHARACTER + byte) for byte in range(256))


def piece_of(token: bytes) -> str:
    return codecs.charmap_decode(token, "strict", CHARACTERS)[0]


def serialize_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece numbers are the ranks.

    Field numbers and type codes are those of the public model format: pieces (1: piece
    1, score 2, type 3), trainer settings (2: type 3 with BPE = 2, vocabulary size 4,
    unknown, begin, end and padding ids 40 to 43), normaliser (3: name 1, dummy prefix 3,
    extra white space 4, escaping 5).
    """
    normal, unknown = 1, 2
    pieces = [
        _field(1, _field(1, piece_of(token)) + _field(2, -float(rank)) + _field(3, normal))
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


@dataclass(frozen=True)
class Vocabulary:
    """Tokens in order of rank, their ids, and the pre-token pattern.

    It is as large as its file, about a megabyte, and goes to the tasks as a whole.
    """

    tokens: tuple[bytes, ...]
    ids: tuple[int, ...]
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        """Read a rank file: on each line a token in base64 and its rank."""
        with open(path, "rb") as lines:
            ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, lines)))
        tokens = tuple(token for _, token in ranked)
        missing = {bytes([b]) for b in range(256)} - set(tokens)
        if missing:
            raise ValueError(f"{len(missing)} single bytes are not in the vocabulary")
        return Vocabulary(tokens, tuple(rank for rank, _ in ranked), pattern)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex
        import sentencepiece

        self.pre_tokens = regex.compile(vocabulary.pattern).findall
        # White space before a space; this class knows a few more characters than the
        # pattern does, which only makes some texts go uncut.
        self.broken_space = re.compile(r"\s ").search
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialize_model(list(vocabulary.tokens)))
        self.ids = vocabulary.ids
        self.whole = {token: n for n, token in enumerate(vocabulary.tokens)}
        self.bytes_of = dict(zip(vocabulary.ids, vocabulary.tokens))
        self.first: dict[str, tuple[int, ...]] = {}
        self.later: dict[str, tuple[int, ...]] = {}

    def _learn(self, memory: dict[str, tuple[int, ...]], keys: set[str], before: str) -> None:
        """Add the ids of new stretches of text, ``before`` put in front of each."""
        stretches = {key: self._matches(before + key) for key in keys}
        ids: dict[str, tuple[int, ...]] = {}
        merged = []
        for match in set(chain.from_iterable(stretches.values())):
            raw = match.encode()
            whole = self.whole.get(raw)
            if whole is None:
                merged.append((match, piece_of(raw)))
            else:
                ids[match] = (self.ids[whole],)
        if merged:
            found = self.model.encode([piece for _, piece in merged], num_threads=1)
            for (match, _), numbers in zip(merged, found):
                ids[match] = tuple(map(self.ids.__getitem__, numbers))
        for key, matches in stretches.items():
            memory[key] = ids[matches[0]] if len(matches) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, matches)))

    def _matches(self, stretch: str) -> list[str]:
        # A run of ASCII letters, with a space or not, is one match.
        if stretch.isascii() and stretch.lstrip(" ").isalpha() and stretch[:2] != "  ":
            return [stretch]
        return self.pre_tokens(stretch)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts.

        No match of the pattern goes on from a character that is not white space into
        white space, so a text may be cut before every space that follows such a
        character; each stretch is looked up, and the new ones are encoded together.
        """
        for memory in (self.first, self.later):
            if len(memory) > MEMORY:
                memory.clear()
        cut = [[text] if self.broken_space(text) else text.split(" ") for text in texts]
        self._learn(self.first, {parts[0] for parts in cut} - self.first.keys(), "")
        later = set(chain.from_iterable(parts[1:] for parts in cut)) - self.later.keys()
        self._learn(self.later, later, " ")
        out = []
        for parts in cut:
            rest = map(self.later.__getitem__, islice(parts, 1, None))
            out.append(list(chain(self.first[parts[0]], chain.from_iterable(rest))))
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(vocabulary: Vocabulary) -> Codec:
    return Codec(vocabulary)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of a batch of about SLICE bytes, one text at least: ids in Python take many
    times the memory of their text."""
    start, size = 0, 0
    for at, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > start and size + length > SLICE:
            yield texts.slice(start, at - start)
            start, size = at, 0
        size += length
    yield texts.slice(start)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded``, the bytes those ids stand for."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared.value)
        for texts in batches:
            for part in _slices(texts):
                ids = codec.encode_all([value or "" for value in part.to_pylist()])
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.binary())], ["ids", "decoded"]
                )

    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), run(F.col(text).cast("string")).alias("out"))
    return packed.select(*[F.col("doc").getField(c).alias(c) for c in kept], "out.*")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids.  Unknown ids are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf(T.BinaryType())
    def run(lists: pa.Array) -> pa.Array:
        codec = _codec(shared.value)
        return pa.array([None if value is None else codec.decode(value) for value in lists.to_pylist()], pa.binary())

    return encoded.withColumn("decoded", run(F.col(ids)))


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> Vocabulary:
    import public_tokenizers

    return Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN)


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, public_vocabulary())
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
