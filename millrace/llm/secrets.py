"""Secret scans that link the parts of a credential.

Strong parts are reported wherever they stand: an assignment to a secret name, an access
identifier with its fixed prefix, a long run of hex digits.  Weak parts say little alone:
an account name, a long mixed string, an endpoint.  They are reported only where the
parts that complete them lie within ``reach`` code points in the same text:

- an identifier where a secret part is near,
- a credential (mixed string) where an identifying part or an endpoint is near,
- an endpoint where both an identifying and a secret part are near.

Everything is DataFrame work.  A pattern's matches get their places from the lengths of
the pieces between them; the nearest earlier and later part of each class come from
running windows in order of place, so the interval join looks at every part a fixed
number of times and makes no pairs.  Texts are not shuffled, only the places; equal
texts are linked once.

Defined results for unusual rows: a null or empty text has no spans; rows with the same
text have the same spans, whatever their ids; an empty table gives an empty result;
places are code points, ends exclusive; columns of the input are kept, the added columns
replace those of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table

REACH = 200


def _either_case(word: str) -> str:
    """A pattern for ASCII letters in either case, the same in every engine."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


SECRET_NAMES = ["password", "passwd", "secret", "token", "api_?key"]
ACCOUNT_NAMES = ["client_id", "access_key_id", "account", "username", "user", "login"]
SIGN = r"""["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Kind:
    """A kind of part: its pattern, a test of each match, its class, and if it is weak.

    ``test`` is a pattern the match must contain (a match that fails is dropped but
    stays consumed).
    """

    name: str
    pattern: str
    part: str
    weak: bool = False
    test: tuple[str, ...] = ()


# In reporting order.  The tails {16,} and {24,} stand for "whole run, then drop the
# short ones": both start at the first place of a run, and no later start is longer.
KINDS = (
    Kind(
        "assign",
        "(" + "|".join(map(_either_case, SECRET_NAMES)) + ")" + SIGN + "([A-Za-z0-9+/_.=-]+)",
        "secret",
        test=(SIGN + "[A-Za-z0-9+/_.=-]{6,}$",),
    ),
    Kind("access", "AKIA[A-Z0-9]{16,}", "identity"),
    Kind("hex", "[0-9a-f]{24,}", "secret"),
    Kind(
        "identifier",
        "(" + "|".join(map(_either_case, ACCOUNT_NAMES)) + ")" + SIGN + "[A-Za-z0-9@._-]{3,}",
        "identity",
        weak=True,
    ),
    Kind("credential", "[A-Za-z0-9+/=_-]{32,}", "secret", weak=True, test=("[A-Z]", "[a-z]", "[0-9]")),
    Kind("endpoint", "https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", "endpoint", weak=True),
)
STRONG = [i for i, kind in enumerate(KINDS) if not kind.weak]


def has_parts(text: Column) -> Column:
    found = F.lit(False)
    for kind in KINDS:
        found = found | text.rlike(kind.pattern)
    return F.coalesce(found, F.lit(False))


def parts(text: Column) -> Column:
    """Per kind an array of (lead, length, valid): the matches in order, each with the
    number of code points between it and the match before."""

    def of(kind: Kind) -> Column:
        def part(piece: Column, match: Column) -> Column:
            valid = F.lit(True)
            for test in kind.test:
                valid = valid & match.rlike(test)
            return F.struct(F.length(piece).alias("lead"), F.length(match).alias("length"), valid.alias("valid"))

        pieces = F.split(text, kind.pattern, -1)
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        zipped = F.filter(F.zip_with(pieces, matches, part), lambda p: p["length"].isNotNull())
        return F.when(text.rlike(kind.pattern), zipped)

    empty = F.array().cast("array<struct<lead:int,length:int,valid:boolean>>")
    return F.struct(*[F.coalesce(of(kind), empty).alias(kind.name) for kind in KINDS])


def _placed(found: DataFrame) -> DataFrame:
    """One row per valid part: ``key, kind, start, end``.  ``found`` has one row per key."""
    def numbered(k: int, kind: Kind) -> Column:
        def one(p: Column, i: Column) -> Column:
            return F.struct(F.lit(k).alias("kind"), i.alias("nth"), *[p[c].alias(c) for c in ("lead", "length", "valid")])

        return F.transform(f"parts.{kind.name}", one)

    listed = F.flatten(F.array(*[numbered(k, kind) for k, kind in enumerate(KINDS)]))
    each = found.select("key", F.explode(listed).alias("p")).select("key", "p.*")
    so_far = Window.partitionBy("key", "kind").orderBy("nth")
    end = F.sum(F.col("lead").cast("bigint") + F.col("length")).over(so_far)
    return each.withColumn("end", end).where("valid").select("key", "kind", (F.col("end") - F.col("length")).alias("start"), "end")


def _nearest(spans: DataFrame, where: Column, name: str) -> DataFrame:
    """Add the code points between each span and the nearest other one that satisfies
    ``where``, before or after it (below zero: they overlap)."""
    ahead = Window.partitionBy("key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("key").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") - F.max(F.when(where, F.col("end"))).over(ahead)
    after = F.min(F.when(where, F.col("start"))).over(back) - F.col("end")
    return spans.withColumn(name, F.least(before, after))


def link(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Reported spans of each key: ``key, spans`` with spans ``(start, kind, end, upto)`` in
    order; ``upto`` is the furthest end of the spans before it.

    ``found`` has ``key`` (a digest of the text) and ``parts``; repeated keys count once.
    """
    once = found.groupBy("key").agg(F.first("parts").alias("parts"))
    spans = _placed(once)
    weak = F.col("kind").isin([i for i, kind in enumerate(KINDS) if kind.weak])
    spans = _nearest(spans, ~weak, "to_strong")
    # A weak part that overlaps a strong one is that one seen again.
    spans = spans.where(~weak | F.col("to_strong").isNull() | (F.col("to_strong") >= 0)).drop("to_strong")
    near = {}
    for part in ("identity", "secret", "endpoint"):
        of_part = F.col("kind").isin([i for i, kind in enumerate(KINDS) if kind.part == part])
        spans = _nearest(spans, of_part, part)
        near[part] = F.coalesce(F.col(part) <= reach, F.lit(False))
    needs = {
        "identifier": near["secret"],
        "credential": near["identity"] | near["endpoint"],
        "endpoint": near["identity"] & near["secret"],
    }
    reported = ~weak
    for k, kind in enumerate(KINDS):
        if kind.weak:
            reported = reported | ((F.col("kind") == k) & needs[kind.name])
    earlier = Window.partitionBy("key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.max("end").over(earlier), F.lit(0).cast("bigint"))
    return (
        spans.where(reported)
        .withColumn("upto", upto)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "upto"))).alias("spans"))
    )


def _joined(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with their key's spans.  Rows without a key have none and skip the join."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,upto:bigint>>")
    with_key = rows.where(F.col("key").isNotNull()).join(spans, "key", "left")
    with_key = with_key.withColumn("spans", F.coalesce("spans", none))
    return with_key.unionByName(rows.where(F.col("key").isNull()).withColumn("spans", none))


def _with_key(docs: DataFrame, text: str, *columns: Column) -> DataFrame:
    """``columns`` and ``key``: the digest of a text that has any part, else null."""
    return docs.select(*columns, F.when(has_parts(F.col(text)), F.md5(F.col(text).cast("binary"))).alias("key"))


def scan_secrets(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind, end, upto), kinds numbered as in KINDS."""
    kept = [c for c in docs.columns if c != "spans"]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    # Texts are read and searched again by what follows: a stored copy of them costs more
    # disk than the search costs time.
    rows = _with_key(docs, text, whole)
    found = rows.where(F.col("key").isNotNull()).select("key", parts(F.col(f"doc.`{text}`")).alias("parts"))
    spans = materialize(link(found, reach), "secret-spans")
    return _joined(rows, spans).select(*[F.col("doc").getField(c).alias(c) for c in kept], "spans")


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; spans that touch or
    overlap are one.  Texts without spans are unchanged, and no row is dropped."""
    names = docs.columns
    scanned = scan_secrets(docs.withColumn("_text", F.col(text)), "_text", reach)
    clean = scanned.where(F.size("spans") == 0).select(*names)
    # Fixed-width code units, so that cutting a piece does not walk the text before it.
    # The explode keeps the encoding from being moved into the lambda below.
    dirty = scanned.where(F.size("spans") > 0).select(
        *names, "spans", F.explode(F.array(F.encode("_text", "UTF-32"))).alias("_units"), F.length("_text").alias("_length")
    )
    gaps = F.transform(
        "spans", lambda p, i: F.struct(p["upto"].alias("from"), p["start"].alias("to"), (i == 0).alias("edge"))
    )
    last = F.element_at("spans", -1)
    tail = F.struct(
        F.greatest(last["upto"], last["end"]).alias("from"),
        F.col("_length").cast("bigint").alias("to"),
        F.lit(True).alias("edge"),
    )
    dirty = dirty.withColumn("_gaps", F.concat(gaps, F.array(tail)))
    piece = lambda g: F.decode(
        F.substring(F.col("_units"), (g["from"] * 4 + 1).cast("int"), ((g["to"] - g["from"]) * 4).cast("int")), "UTF-32"
    )
    pieces = F.transform(
        F.filter("_gaps", lambda g: (g["to"] > g["from"]) | g["edge"]),
        lambda g: F.when(g["to"] > g["from"], piece(g)).otherwise(F.lit("")),
    )
    redacted = dirty.withColumn("_redacted", F.array_join(pieces, mark))
    return clean.unionByName(
        redacted.select(*[F.col("_redacted").alias(c) if c == text else F.col(f"`{c}`") for c in names])
    )


def _spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
    )


def _sql() -> str:
    """The same result for DuckDB: pieces, places, nearest parts, reported spans."""
    quoted = [kind.pattern.replace("'", "''") for kind in KINDS]
    each = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, string_split_regex(text, '{pattern}') AS pieces, "
        f"regexp_extract_all(text, '{pattern}', 0) AS found FROM documents"
        for k, pattern in enumerate(quoted)
    )
    valid = " AND ".join(
        f"(kind <> {k} OR regexp_matches(hit, '{test.replace(chr(39), chr(39) * 2)}'))"
        for k, kind in enumerate(KINDS)
        for test in kind.test
    )
    strong = f"kind IN ({', '.join(map(str, STRONG))})"
    of = {
        part: f"kind IN ({', '.join(str(i) for i, kind in enumerate(KINDS) if kind.part == part)})"
        for part in ("identity", "secret", "endpoint")
    }

    def nearest(which: str) -> str:
        ahead = "PARTITION BY doc_id ORDER BY start, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        later = "PARTITION BY doc_id ORDER BY start, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
        return (
            f"least(start - max(CASE WHEN {which} THEN finish END) OVER ({ahead}), "
            f"min(CASE WHEN {which} THEN start END) OVER ({later}) - finish)"
        )

    names = [kind.name for kind in KINDS]
    weak = {
        "identifier": "coalesce(secret <= {0}, false)",
        "credential": "(coalesce(identity <= {0}, false) OR coalesce(endpoint <= {0}, false))",
        "endpoint": "(coalesce(identity <= {0}, false) AND coalesce(secret <= {0}, false))",
    }
    reported = " OR ".join([strong] + [f"(kind = {names.index(n)} AND {rule.format(REACH)})" for n, rule in weak.items()])
    name = "CASE kind " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(names)) + " END"
    spelled = f"{name} || ':' || start || ':' || finish"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {k}) AS n_{n}" for k, n in enumerate(names) if k in STRONG)
    zeros = ", ".join(f"coalesce(n_{names[k]}, 0) AS n_{names[k]}" for k in STRONG)
    return f"""
WITH matched AS ({each}),
part AS (SELECT doc_id, kind, unnest(range(1, len(found) + 1)) AS nth, pieces, found FROM matched),
piece AS (SELECT doc_id, kind, nth, length(pieces[nth]) AS lead, found[nth] AS hit FROM part),
placed AS (
  SELECT *, CAST(sum(lead + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS BIGINT) AS finish FROM piece),
sound AS (SELECT doc_id, kind, finish - length(hit) AS start, finish FROM placed WHERE {valid}),
beside AS (SELECT *, {nearest(strong)} AS to_strong FROM sound),
apart AS (SELECT doc_id, kind, start, finish FROM beside WHERE {strong} OR to_strong IS NULL OR to_strong >= 0),
near AS (SELECT *, {nearest(of["identity"])} AS identity, {nearest(of["secret"])} AS secret, {nearest(of["endpoint"])} AS endpoint FROM apart),
spans AS (SELECT * FROM near WHERE {reported}),
told AS (
  SELECT doc_id, {counts},
    string_agg({spelled}, ',' ORDER BY start, kind) FILTER (WHERE {strong}) AS base,
    string_agg({spelled}, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told USING (doc_id)
"""


@query("op10_link_secrets", _sql())
def op10_link_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = _with_key(docs, "text", F.col("doc_id"), parts(F.col("text")).alias("parts"))
    found = materialize(found, "secret-parts")
    spans = link(found.where(F.col("key").isNotNull()))
    rows = _joined(found.select("doc_id", "key"), spans)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k].name}")
    base = F.filter("spans", lambda s: s["kind"].isin(STRONG))
    return rows.select(
        "doc_id",
        *[count(k) for k in STRONG],
        F.sha2(_spelled(base).cast("binary"), 256).alias("base_sha256"),
        _spelled(F.col("spans")).alias("spans"),
    )
