"""Subject naming and matching as string expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic prefixes removed when a topic becomes a subject.
DATA_PREFIX = "/data/"
EVENT_PREFIX = "/event/"


def subject_matches(subject: Column, pattern: str) -> Column:
    """Token wildcards: ``*`` is exactly one token, a closing ``>`` one or more.

    Patterns without wildcards become equality, and ``prefix.>`` a prefix test,
    so both reach the Parquet scan; only the rest need a regular expression.
    """
    tokens = _tokens(pattern)
    if "*" not in tokens:
        if tokens[-1] != ">":
            return subject == F.lit(pattern)
        if len(tokens) > 1:
            prefix = ".".join(tokens[:-1]) + "."
            return subject.startswith(prefix) & (F.length(subject) > len(prefix))
        return F.length(subject) > 0
    parts = []
    for token in tokens:
        if token == "*":
            parts.append(r"[^.]+")
        elif token == ">":
            parts.append(r".+")
        else:
            parts.append(re.escape(token))
    return subject.rlike("^" + r"\.".join(parts) + "$")


@dataclass(frozen=True, order=True)
class Shape:
    """What patterns have in common: how many tokens, which of them are ``*``, and
    whether ``>`` closes them.  All patterns of a shape are one lookup by key."""

    size: int
    stars: tuple[int, ...]
    tail: bool

    @classmethod
    def of(cls, pattern: str) -> Shape:
        tokens = _tokens(pattern)
        tail = tokens[-1] == ">"
        fixed = tokens[:-1] if tail else tokens
        return cls(len(fixed), tuple(i for i, t in enumerate(fixed) if t == "*"), tail)

    def pattern_key(self, pattern: str) -> str:
        return ".".join(t for i, t in enumerate(_tokens(pattern)[: self.size]) if i not in self.stars)

    def subject_key(self, tokens: Column) -> Column:
        """The same key of a subject given as its tokens; null if it is not of the shape."""
        kept = [F.get(tokens, F.lit(i)) for i in range(self.size) if i not in self.stars]
        fits = F.size(tokens) > self.size if self.tail else F.size(tokens) == self.size
        for star in self.stars:
            fits = fits & (F.get(tokens, F.lit(star)) != "")
        if self.tail:
            rest = F.slice(tokens, F.lit(self.size + 1), F.greatest(F.size(tokens) - self.size, F.lit(0)))
            fits = fits & (F.array_join(rest, ".") != "")
        return F.when(fits, F.concat_ws(".", *kept) if kept else F.lit(""))


def _tokens(pattern: str) -> list[str]:
    tokens = pattern.split(".")
    if any(not t for t in tokens) or ">" in tokens[:-1]:
        raise ValueError(f"bad subject pattern {pattern!r}")
    return tokens


def source_subject(topic: Column) -> Column:
    """Topic → subject on the way in: drop one known prefix, then lower-case."""
    bare = (
        F.when(topic.startswith(DATA_PREFIX), F.substring(topic, len(DATA_PREFIX) + 1, 2**31 - 1))
        .when(topic.startswith(EVENT_PREFIX), F.substring(topic, len(EVENT_PREFIX) + 1, 2**31 - 1))
        .otherwise(topic)
    )
    return F.lower(bare)


def publish_subject(topic: Column) -> Column:
    """Topic → subject on the way out.

    A topic starting with a separator becomes dotted lower case without the
    leading dot; any other topic is returned untouched, original case included.
    """
    dotted = F.lower(F.translate(topic, "/", "."))
    return F.when(
        dotted.startswith("."), F.substring(dotted, 2, 2**31 - 1)
    ).otherwise(topic)


def path_subject(subject: Column) -> Column:
    """``pubsub.data.x`` / ``pubsub.event.x`` → ``data/x`` / ``event/x``; others unchanged."""
    parts = F.split(subject, r"\.")
    routed = (
        (F.size(parts) >= 3)
        & (F.get(parts, F.lit(0)) == "pubsub")
        & F.get(parts, F.lit(1)).isin("data", "event")
    )
    return F.when(routed, F.concat_ws("/", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))).otherwise(
        subject
    )
