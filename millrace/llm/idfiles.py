"""Token ids in files: Re-Pair shards that can be read from the middle.

Texts are dealt by ranges of their id, so that the files follow each other in ascending
order.  A task encodes the texts of its range with the tokenizers library, ends each with
an id, and cuts the ids into shards of a bounded size, each compressed by its own Re-Pair
grammar (``repair``: rules, expansion lengths, symbols).  A shard is one binary value in
the format of ``repair.Shard``; the shards of a task are rows of one Parquet file, so that
any store that Spark writes to can hold them, and their ranges of ids are column
statistics that a reader skips by.  A manifest, one row a file, has where each file
begins.

The library splits a text by its pattern and encodes each part alone.  Parts repeat, so a
task asks the library's model for every different part once and looks the others up by 128
bits of a hash, all parts of many texts at once.  Texts that
hold a special token or a character that is in no older Unicode version (on which the
pattern's libraries differ), and tokenizers of another kind, go through it whole.

Defined results for unusual rows: a null text is encoded as an empty one (the end id
alone); texts of any length are encoded whole, and a shard holds one document at least;
null ids come first; rows of one id follow each other by a hash of their text, and each
keeps its own place; an empty table gives no shards; only the two named columns are
written.
"""

from __future__ import annotations

import codecs
import functools
import json
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .registry import query, table
from .repair import Shard, compress

# Ids of a shard, and of parts of texts that a task remembers.
SHARD_IDS = 1 << 19
MEMORY = 1_500_000
# Texts that are split at a time, by characters.
SLICE = 1 << 20

# What byte-level tokenizers of this kind split a text into.  Letters,
# numbers and other characters in runs, each with one space before it if there is one;
# white space but its last character; and these endings after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)

SHARDS = "file int, shard int, start long, first_doc long, last_doc long, n_docs long, n_ids long, content binary"
DOCUMENTS = "file int, doc_id long, start long, n_tokens long, ids binary"


@functools.cache
def character_kinds() -> np.ndarray:
    """The kind of every code point; UNKNOWN where Python's Unicode tables have none."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        if category == "Cn":
            out[code] = UNKNOWN
        elif category[0] in "LN":
            out[code] = LETTER if category[0] == "L" else NUMBER
    # White space as Unicode has it.
    out[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def split_places(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin: ``codes`` are the code points of texts one after
    the other, ``starts`` the places at which a text begins (none is empty)."""
    size = len(codes)
    kinds = character_kinds()[codes]
    begins = np.ones(size, bool)
    begins[1:] = kinds[1:] != kinds[:-1]
    text = np.zeros(size + 1, bool)
    text[starts] = text[size] = True
    begins |= text[:size]
    # The last of some white space: a space goes to what follows, others stand alone.
    space = kinds == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~text[1:size])
    begins[last] = True
    begins[last[codes[last] == 0x20] + 1] = False
    # An apostrophe that begins a part and is alone takes an ending with it.
    marks = np.flatnonzero((codes[:-1] == 0x27) & begins[:-1] & (kinds[1:] == LETTER) & ~text[1:size])
    for ending in ENDINGS:
        ends = marks + 1 + len(ending)
        inside = ends <= size
        found, ends = marks[inside], ends[inside]
        for k, letter in enumerate(ending):
            fits = (codes[found + 1 + k] == ord(letter)) & ~text[found + 1 + k]
            found, ends = found[fits], ends[fits]
        begins[found + 1] = False
        begins[ends[ends < size]] = True
    return np.flatnonzero(begins)


@functools.cache
def _byte_table() -> str:
    """The characters that stand for bytes in byte-level vocabularies.  Those
    that can be printed stand for themselves, the others follow from 256 on in order."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printed]
    return "".join(chr(byte if byte in printed else 256 + others.index(byte)) for byte in range(256))


def _byte_characters(text: str) -> str:
    return codecs.charmap_decode(text.encode("utf-8"), "strict", _byte_table())[0]


# Two odd bases of hashes, and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(base, -1, 1 << 64) for base in BASES)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
# Slots of the table of parts; of two parts of one slot the later one stays.
SLOT_BITS = 20
# Longer parts are not told by their hashes.
LONGEST = 256


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def part_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a hash of each part's code points, the same wherever it stands."""
    size, out = 1 << max(len(codes) - 1, 1).bit_length(), []
    lengths = (ends - begins).astype(np.uint64) * SPREAD
    sums = np.zeros(len(codes) + 1, np.uint64)
    for base, inverse in zip(BASES, INVERSES):
        np.cumsum(codes * _powers(base, size)[: len(codes)], dtype=np.uint64, out=sums[1:])
        found = (sums[ends] - sums[begins]) * _powers(inverse, size)[begins] ^ lengths
        out.append((found ^ found >> np.uint64(32)) * SPREAD)
    return out[0], out[1]


def _inside(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths one after the other: each place's run, and its place there."""
    runs = np.repeat(np.arange(len(lengths)), lengths)
    return runs, np.arange(len(runs)) - (np.cumsum(lengths) - lengths)[runs]


class _Lists:
    """Lists of numbers one after the other, with room to grow."""

    def __init__(self) -> None:
        self.values, self.size = np.zeros(1 << 12, np.uint32), 0
        self.begins, self.lengths, self.count = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64), 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.values = _room(self.values, self.size + len(values))
        self.begins, self.lengths = (_room(a, self.count + len(lengths)) for a in (self.begins, self.lengths))
        self.values[self.size : self.size + len(values)] = values
        rows = slice(self.count, self.count + len(lengths))
        self.begins[rows], self.lengths[rows] = self.size + np.cumsum(lengths) - lengths, lengths
        self.size, self.count = self.size + len(values), self.count + len(lengths)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Encoder:
    """Ids of texts, as the tokenizers library gives them without special tokens added."""

    def __init__(self, definition: str, memory: int = MEMORY) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        parts = json.loads(definition)
        splits = parts.get("pre_tokenizer") or {}
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_parts = not parts.get("normalizer") and all(splits.get(k) == v for k, v in known.items())
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        """The ids of each part; both hashes of all parts, sorted by the first, with their
        numbers; and slots for those seen last."""
        self.ids = _Lists()
        self.first, self.second, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        size = 1 << SLOT_BITS
        self.slots = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def _learn(self, parts: list[str], first: np.ndarray, second: np.ndarray) -> None:
        """Encode parts that are not known, each by itself, and keep their ids."""
        numbers = self._keep(parts)
        first, second = np.concatenate([self.first, first]), np.concatenate([self.second, second])
        order = np.argsort(first, kind="stable")
        self.first, self.second, self.numbers = first[order], second[order], np.concatenate([self.numbers, numbers])[order]

    def _keep(self, parts: list[str]) -> np.ndarray:
        """Numbers of new parts."""
        tokenize = self.library.model.tokenize
        learned = [[token.id for token in tokenize(_byte_characters(part))] for part in parts]
        numbers = np.arange(self.ids.count, self.ids.count + len(parts), dtype=np.int32)
        lengths = np.fromiter(map(len, learned), np.int64, len(learned))
        self.ids.extend(np.fromiter(chain.from_iterable(learned), np.uint32, int(lengths.sum())), lengths)
        return numbers

    def _by_hash(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if not len(self.first):
            return np.full(len(first), -1, np.int32)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), self.numbers[at], np.int32(-1))

    def _numbers(self, text: str, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.ids.count > self.memory:
            self._forget()
        first, second = part_hashes(codes, begins, ends)
        slots = first >> np.uint64(64 - SLOT_BITS)
        held_first, held_second, held = self.slots
        numbers = np.where((held_first[slots] == first) & (held_second[slots] == second), held[slots], np.int32(-1))
        long = np.flatnonzero(ends - begins > LONGEST)
        numbers[long] = self._keep([text[a:b] for a, b in zip(begins[long].tolist(), ends[long].tolist())])
        asked = np.flatnonzero(numbers < 0)
        numbers[asked] = self._by_hash(first[asked], second[asked])
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            _, places = np.unique(first[unknown], return_index=True)
            places = unknown[places]
            self._learn([text[a:b] for a, b in zip(begins[places].tolist(), ends[places].tolist())], first[places], second[places])
            numbers[unknown] = self._by_hash(first[unknown], second[unknown])
            # Parts that share the first hash with another one are not kept.
            left = np.flatnonzero(numbers < 0)
            numbers[left] = self._keep([text[a:b] for a, b in zip(begins[left].tolist(), ends[left].tolist())])
        held_first[slots[asked]], held_second[slots[asked]], held[slots[asked]] = first[asked], second[asked], numbers[asked]
        return numbers

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = [i for i, text in enumerate(texts) if text and self.by_parts and not any(token in text for token in self.special)]
        whole = {i for i, text in enumerate(texts) if text}.difference(plain)
        if plain:
            joined = "".join([texts[i] for i in plain])
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            sizes = np.fromiter((len(texts[i]) for i in plain), np.int64, len(plain))
            starts = np.cumsum(sizes) - sizes
            strange = np.flatnonzero(character_kinds()[codes] == UNKNOWN)
            whole |= {plain[k] for k in np.searchsorted(starts, strange, "right") - 1}
            begins = split_places(codes, starts)
            ends = np.append(begins[1:], len(codes))
            numbers = self._numbers(joined, codes, begins, ends)
            lengths = self.ids.lengths[numbers]
            runs, at = _inside(lengths)
            ids = self.ids.values[self.ids.begins[numbers][runs] + at]
            cuts = np.concatenate([[0], np.cumsum(lengths)])[np.append(np.searchsorted(begins, starts), len(begins))].tolist()
            for i, a, b in zip(plain, cuts, cuts[1:]):
                out[i] = ids[a:b]
        for i in whole:
            out[i] = self._whole(texts[i])
        return out


@functools.lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    """One for all tasks of a worker: later ones find what earlier ones learned."""
    return Encoder(definition)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of a list of about SLICE characters, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > SLICE:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


class _Writer:
    """Rows of shards from documents in their order."""

    def __init__(self, file: int, first: int, shard_ids: int) -> None:
        self.file, self.first, self.shard_ids = file, first, shard_ids
        self.shard, self.start, self.size = 0, 0, 0
        self.docs: list[tuple[int | None, np.ndarray]] = []

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[dict]:
        if self.docs and self.size + len(ids) > self.shard_ids:
            yield self.cut()
        self.docs.append((doc, ids))
        self.size += len(ids)

    def cut(self) -> dict:
        named = [doc for doc, _ in self.docs if doc is not None]
        shard = Shard(
            compress(np.concatenate([ids for _, ids in self.docs]), self.first),
            np.array([doc or 0 for doc, _ in self.docs], np.int64),
            np.array([doc is None for doc, _ in self.docs], np.uint8),
            np.array([len(ids) for _, ids in self.docs], np.int64),
        )
        row = {
            "file": self.file,
            "shard": self.shard,
            "start": self.start,
            "first_doc": min(named, default=None),
            "last_doc": max(named, default=None),
            "n_docs": len(self.docs),
            "n_ids": self.size,
            "content": shard.to_bytes(),
        }
        self.shard, self.start = self.shard + 1, self.start + self.size
        self.size, self.docs = 0, []
        return row


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))])


def write_files(
    docs: DataFrame, path: str, definition: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, files: int | None = None, shard_ids: int = SHARD_IDS
) -> None:
    """Write the ids of every text, ``end_id`` after each, under ``path``.

    ``definition`` is the tokenizer's JSON.  ``files`` bounds the number of files; by
    default the session's shuffle partitions, joined where they are small.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    shape, arrow = json.loads(definition), _arrow(SHARDS)
    added = [token["id"] for token in shape.get("added_tokens", [])]
    first = max([end_id, *added, *shape["model"]["vocab"].values()]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        writer = _Writer(TaskContext.get().partitionId(), first, shard_ids)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [value or "" for value in batch.column("text").to_pylist()]
            for start, end in _slices(texts):
                for doc, own in zip(ids[start:end], encoder.encode(texts[start:end])):
                    for row in writer.add(doc, np.append(own, np.uint32(end_id))):
                        yield pa.RecordBatch.from_pylist([row], arrow)
        if writer.docs:
            yield pa.RecordBatch.from_pylist([writer.cut()], arrow)

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Rows of one id, even equal ones, may lie in several files.
    keyed = named.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = ["doc_id", "hash", "place"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    shards = dealt.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, SHARDS)
    shards.write.parquet(f"{path}/shards")
    spark = docs.sparkSession
    sizes = spark.read.schema(SHARDS).parquet(f"{path}/shards").groupBy("file").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    rows, start = [], 0
    for file, n_docs, n_ids in sorted(map(tuple, sizes.collect())):
        rows.append((file, start, n_docs, n_ids))
        start += n_ids
    spark.createDataFrame(rows, "file int, begin long, n_docs long, n_ids long").coalesce(1).write.parquet(f"{path}/manifest")


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of shards, ``start`` counted from the first file's beginning."""
    manifest = spark.read.parquet(f"{path}/manifest").select("file", "begin")
    rows = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    # One row a file, as many as there were tasks.
    placed = rows.join(F.broadcast(manifest), "file")
    return placed.withColumn("start", F.col("start") + F.col("begin")).drop("begin")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document: ``doc_id, start, n_tokens, ids``; ``start`` counts the ids of all
    documents before it, ``ids`` are unsigned 32-bit numbers, little-endian."""
    arrow = _arrow(DOCUMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard.from_bytes(batch.column("content")[row].as_py())
                ids, offsets = shard.grammar.expand(), np.r_[shard.begins, shard.doc_lengths.sum()] * 4
                if len(ids) * 4 < 1 << 31:
                    values = pa.Array.from_buffers(pa.binary(), len(shard.docs), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                else:
                    values = pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1] // 4, offsets[1:] // 4)], pa.binary())
                begin = batch.column("start")[row].as_py()
                columns = [
                    pa.array(np.full(len(shard.docs), batch.column("file")[row].as_py(), np.int32)),
                    pa.array(shard.docs, mask=shard.nulls.astype(bool)),
                    pa.array(begin + shard.begins),
                    pa.array(shard.doc_lengths),
                    values,
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    # Shards are large: a few in a batch, not thousands.
    return shards(spark, path).select("file", "start", "content").mapInArrow(run, DOCUMENTS).drop("file")


def read_spans(spark: SparkSession, path: str, spans: DataFrame, cell: int = SHARD_IDS) -> DataFrame:
    """``span, start, ids`` of every row ``span, begin, length`` of ``spans``: ids from the
    place ``begin`` of all files, in the parts that lie in one shard each.

    Only the shards that a span touches are opened and only its symbols are expanded.
    Spans and shards meet by the cells of ``cell`` ids that they touch.
    """
    arrow = _arrow("span long, start long, ids binary")
    cells = lambda begin, end: F.sequence(F.floor(begin / cell), F.floor((end - 1) / cell))
    wanted = spans.where(F.col("length") > 0).select("span", "begin", (F.col("begin") + F.col("length")).alias("end"))
    wanted = wanted.withColumn("cell", F.explode(cells(F.greatest("begin", F.lit(0)), F.col("end"))))
    index = shards(spark, path).select("file", "shard", "start", "n_ids").withColumn("cell", F.explode(cells(F.col("start"), F.col("start") + F.col("n_ids"))))
    touch = (F.col("begin") < F.col("start") + F.col("n_ids")) & (F.col("end") > F.col("start"))
    # A pair that shares several cells counts in the first of them.
    first = F.col("cell") == F.greatest(F.floor(F.greatest("begin", F.lit(0)) / cell), F.floor(F.col("start") / cell))
    met = wanted.join(index, "cell").where(touch & first).drop("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grammar = Shard.from_bytes(row["content"]).grammar
                begin = max(row["begin"] - row["start"], 0)
                end = min(row["end"] - row["start"], row["n_ids"])
                found = {"span": row["span"], "start": row["start"] + begin, "ids": grammar.span(begin, end).astype("<u4").tobytes()}
                yield pa.RecordBatch.from_pylist([found], arrow)

    contents = spark.read.schema(SHARDS).parquet(f"{path}/shards").select("file", "shard", "content")
    return met.join(contents, ["file", "shard"]).select("span", "begin", "end", "start", "n_ids", "content").mapInArrow(run, "span long, start long, ids binary")


def public_definition(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as lines:
        return lines.read()


@query("op13_id_files")
def op13_id_files(spark, sf_dir):
    path = scratch_path(spark, "id-files")
    write_files(table(spark, sf_dir, "documents"), path, public_definition())
    found = read_files(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
