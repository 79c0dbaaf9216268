"""Re-Pair grammar compression of sequences of ids, and random access to what it wrote.

Frequent neighbouring pairs are replaced by new symbols again and again.  One pass takes
all pairs that are frequent enough, more frequent ones first where they overlap, so that
a few passes over numpy arrays do what would otherwise be a walk for each pair.  A pair
that got its symbol in an earlier pass keeps it.  Passes end when one shortens the
sequence by less than a stated share.

The grammar is the list of rules (a symbol and its two halves), the expansion length of
each and the passes they came from; a rule only refers to symbols of earlier passes.  The
lengths place any span of the sequence without expanding what lies before it.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

# A rule has to be used so often: it costs two symbols and a length.
LEAST_USES = 4
# A pass has to shorten the sequence by this share.
LEAST_GAIN = 1 / 50
# Slots of the table that finds the pairs of a pass.
SLOT_BITS = 17

MAGIC = b"RPID"
HEADER = struct.Struct("<4s7Q")
UNRANKED = np.int32(2**31 - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _pair_bits(top: int) -> int:
    """Half the width of a pair of symbols below ``top``: narrow keys sort faster."""
    return 16 if top <= 1 << 16 else 32


def _pairs(symbols: np.ndarray, bits: int) -> np.ndarray:
    wide = symbols.astype(np.uint32 if bits == 16 else np.uint64)
    return wide[:-1] << bits | wide[1:]


def _slot(pairs: np.ndarray) -> np.ndarray:
    if pairs.dtype == np.uint32:
        return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
    return (pairs * SPREAD) >> np.uint64(64 - SLOT_BITS)


def _frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with ``least`` occurrences and their counts, most frequent first."""
    ordered = np.sort(pairs)
    if len(ordered) < least:
        return ordered[:0], np.zeros(0, np.int64)
    many = ordered[least - 1 :] == ordered[: len(ordered) - least + 1]
    found = ordered[: len(many)][many]
    found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    counts = np.searchsorted(ordered, found, "right") - np.searchsorted(ordered, found, "left")
    order = np.lexsort((found, -counts))
    return found[order], counts[order]


def _without_overlaps(ranks: np.ndarray) -> None:
    """In a run of one symbol the same pair stands at every place: take every second out."""
    same = np.flatnonzero((ranks[1:] == ranks[:-1]) & (ranks[1:] != UNRANKED)) + 1
    if not len(same):
        return
    first = np.concatenate([[True], np.diff(same) > 1])
    begins = same[np.maximum.accumulate(np.where(first, np.arange(len(same)), 0))] - 1
    ranks[same[(same - begins) % 2 == 1]] = UNRANKED


@dataclass
class Grammar:
    """``symbols`` stand for ids below ``first`` or, from there on, for ``rules``."""

    first: int
    symbols: np.ndarray
    rules: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.uint32))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    passes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    @cached_property
    def all_lengths(self) -> np.ndarray:
        """The expansion length of every symbol, ids included."""
        return np.concatenate([np.ones(self.first, np.int64), self.lengths.astype(np.int64)])

    @cached_property
    def ends(self) -> np.ndarray:
        """Where the expansion of each symbol of the sequence ends."""
        return np.cumsum(self.all_lengths[self.symbols])

    @cached_property
    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All expansions one after the other, and where each begins."""
        lengths = self.all_lengths
        begins = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.uint32)
        flat[: self.first] = np.arange(self.first)
        start = 0
        for end in self.passes.astype(np.int64).tolist():
            own, at = self.rules[start:end], begins[self.first + start : self.first + end]
            _copy(flat, at, begins[own[:, 0]], lengths[own[:, 0]])
            _copy(flat, at + lengths[own[:, 0]], begins[own[:, 1]], lengths[own[:, 1]])
            start = end
        return flat, begins

    def expand(self) -> np.ndarray:
        """The whole sequence of ids."""
        flat, begins = self.expansions
        return flat[_ragged(begins[self.symbols], self.all_lengths[self.symbols])]

    def span(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the sequence; only rules on the way are expanded."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        left, right = np.searchsorted(self.ends, begin, "right"), np.searchsorted(self.ends, end, "left")
        place = int(self.ends[left] - self.all_lengths[self.symbols[left]])
        todo, out = [], []
        for symbol in self.symbols[left : right + 1].tolist():
            todo.append((symbol, place))
            place += int(self.all_lengths[symbol])
        todo.reverse()
        while todo:
            symbol, place = todo.pop()
            length = int(self.all_lengths[symbol])
            if place >= end or place + length <= begin:
                continue
            if symbol < self.first:
                out.append(symbol)
                continue
            a, b = self.rules[symbol - self.first].tolist()
            todo.append((b, place + int(self.all_lengths[a])))
            todo.append((a, place))
        return np.array(out, np.uint32)


def _ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each length, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(total)


def _copy(flat: np.ndarray, to: np.ndarray, source: np.ndarray, lengths: np.ndarray) -> None:
    flat[_ragged(to, lengths)] = flat[_ragged(source, lengths)]


def compress(ids: np.ndarray, first: int, least: int = LEAST_USES, gain: float = LEAST_GAIN) -> Grammar:
    """The grammar of ``ids``, all below ``first``."""
    symbols = np.array(ids, np.uint32)
    if len(symbols) and int(symbols.max()) >= first:
        raise ValueError(f"ids must be below {first}")
    halves, lengths, passes = np.zeros((0, 2), np.uint32), np.ones(first, np.int64), []
    while len(symbols) > 1:
        bits = _pair_bits(len(lengths))
        pairs = _pairs(symbols, bits)
        known = halves[:, 0].astype(pairs.dtype) << bits | halves[:, 1].astype(pairs.dtype)
        frequent, _ = _frequent(pairs, least)
        candidates, numbers = frequent, np.full(len(frequent), -1, np.int64)
        if len(known):
            # Known pairs keep their symbols, whether they are frequent now or not.
            order = np.argsort(known)
            at = np.minimum(np.searchsorted(known[order], frequent), len(known) - 1)
            old = known[order][at] == frequent
            numbers[old] = first + order[at[old]]
            rest = np.ones(len(known), bool)
            rest[order[at[old]]] = False
            candidates = np.concatenate([frequent, known[rest]])
            numbers = np.concatenate([numbers, first + np.flatnonzero(rest)])
        if not len(candidates):
            break
        # Of pairs in one slot the less frequent wait for another pass.
        _, kept = np.unique(_slot(candidates), return_index=True)
        kept.sort()
        candidates, numbers = candidates[kept], numbers[kept]
        slots, table = _slot(candidates), np.full(1 << SLOT_BITS, UNRANKED)
        holds = np.zeros(1 << SLOT_BITS, pairs.dtype)
        holds[slots], table[slots] = candidates, np.arange(len(candidates), dtype=np.int32)
        place = _slot(pairs)
        ranks = np.full(len(pairs) + 2, UNRANKED)
        ranks[1:-1] = np.where(holds[place] == pairs, table[place], UNRANKED)
        _without_overlaps(ranks[1:-1])
        chosen = np.flatnonzero((ranks[1:-1] < ranks[:-2]) & (ranks[1:-1] < ranks[2:]))
        chosen_ranks = ranks[1:-1][chosen]
        worth = (numbers >= 0) | (np.bincount(chosen_ranks, minlength=len(candidates)) >= least)
        chosen, chosen_ranks = chosen[worth[chosen_ranks]], chosen_ranks[worth[chosen_ranks]]
        if not len(chosen):
            break
        new = np.flatnonzero((numbers < 0) & worth)
        numbers[new] = len(lengths) + np.arange(len(new))
        own = np.stack([candidates[new] >> bits, candidates[new] & ((1 << bits) - 1)], axis=1).astype(np.uint32)
        lengths = np.concatenate([lengths, lengths[own[:, 0]] + lengths[own[:, 1]]])
        halves = np.concatenate([halves, own])
        passes.append(len(halves))
        symbols[chosen] = numbers[chosen_ranks]
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols = symbols[keep]
        if len(chosen) < gain * len(pairs):
            break
    return Grammar(first, symbols, halves, lengths[first:].astype(np.uint64), np.array(passes, np.uint64))


def _narrow(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers in ``width`` bytes each, little-endian."""
    return np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _wide(content: memoryview, width: int) -> np.ndarray:
    out = np.zeros((len(content) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(content, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.uint32, copy=False)


@dataclass
class Shard:
    """A grammar and the documents it holds: their ids (null ones marked) and lengths."""

    grammar: Grammar
    docs: np.ndarray
    nulls: np.ndarray
    doc_lengths: np.ndarray

    @cached_property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.doc_lengths) - self.doc_lengths

    def to_bytes(self) -> bytes:
        """Magic and seven counts; document ids (8 bytes), their null marks (1) and lengths
        (8); passes (8), expansion lengths (8), rules and symbols in as many bytes as the
        largest symbol needs (2 to 4).  All little-endian."""
        own = self.grammar
        top = own.first + len(own.rules)
        width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
        header = HEADER.pack(MAGIC, 1, own.first, len(self.docs), len(own.passes), len(own.rules), len(own.symbols), width)
        plain = [self.docs.astype("<i8"), self.nulls.astype("u1"), self.doc_lengths.astype("<u8"), own.passes.astype("<u8"), own.lengths.astype("<u8")]
        return b"".join([header, *[a.tobytes() for a in plain], _narrow(own.rules, width), _narrow(own.symbols, width)])

    @classmethod
    def from_bytes(cls, content: bytes) -> Shard:
        magic, version, first, docs, passes, rules, symbols, width = HEADER.unpack_from(content)
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard of ids")
        view, at = memoryview(content), HEADER.size

        def take(size: int) -> memoryview:
            nonlocal at
            at += size
            return view[at - size : at]

        own = np.frombuffer(take(8 * docs), "<i8")
        nulls, lengths = np.frombuffer(take(docs), "u1"), np.frombuffer(take(8 * docs), "<u8").astype(np.int64)
        ends, expanded = np.frombuffer(take(8 * passes), "<u8"), np.frombuffer(take(8 * rules), "<u8")
        halves = _wide(take(2 * rules * width), width).reshape(-1, 2)
        return cls(Grammar(first, _wide(take(symbols * width), width), halves, expanded, ends), own, nulls, lengths)
