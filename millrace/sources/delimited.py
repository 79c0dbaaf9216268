"""Delimited text whose quoted values may hold line ends, read in splits.

A line alone does not tell whether it starts inside a quoted value.  What it does tell is
where it ends for either start: one pass gives every line that *transfer*.  Transfers
compose, so each split has one as well, and a prefix scan over one row per split gives
every split its start.  Splits in which no line leaves a quote open and that start
outside are records line by line; only lines of the others are numbered and put together,
and records that reach over a split's end are joined from their few parts.

Quotes follow RFC 4180 (doubled inside quotes).  As in the readers that Spark has, a quote
inside a value that does not begin with one is an ordinary character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import listing, materialize

QUOTE = '"'
# Rows of a broadcast table: one a file or a split.
BROADCAST_ROWS = 100_000

# States while the quotes of a line are walked.  A line begins like a value after a
# closing quote: the next quote opens if nothing stands before it.
_CLOSED, _INSIDE, _LITERAL = 0, 1, 2


def small(table: DataFrame) -> DataFrame:
    """Broadcast a stored table of at most BROADCAST_ROWS rows; leave a larger one."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def text_lines(spark: SparkSession, paths: list[str], *, options: dict[str, str] | None = None, line_ending: str | None = None) -> DataFrame:
    """``file, block, place, parts, line``: lines in splits.

    ``block`` is where the split starts in its file, ``place`` grows along a split, and
    ``parts`` holds partition columns of the folder.  Without ``line_ending`` lines end
    with a line feed, and a carriage return before it stays.
    """
    with listing(spark):
        text = spark.read.options(**(options or {})).option("lineSep", line_ending or "\n").text(paths)
    folders = [F.col(f"`{c}`") for c in text.columns if c != "value"]
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.struct(*(folders or [F.lit(0).alias("none")])).alias("parts"),
        F.col("value").alias("line"),
    )


def ends_inside(line: Column, delimiter: str, inside: bool) -> Column:
    """Whether a line that starts inside (or outside) a quoted value ends inside one."""

    def after_quote(state: Column, piece: Column) -> Column:
        opens = ((state == _CLOSED) & (piece == "")) | F.endswith(piece, F.lit(delimiter))
        return F.when(state == _INSIDE, _CLOSED).when(opens, _INSIDE).otherwise(_LITERAL)

    pieces = F.split(line, QUOTE, -1)
    before_quotes = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    start = F.lit(_INSIDE if inside else _CLOSED)
    walked = F.aggregate(before_quotes, start, after_quote) == _INSIDE
    return F.when(F.contains(line, F.lit(QUOTE)), walked).otherwise(F.lit(inside))


def _both_ends(line: Column, delimiter: str) -> list[Column]:
    return [ends_inside(line, delimiter, False).alias("from_outside"), ends_inside(line, delimiter, True).alias("from_inside")]


def _xor(a: Column, b: Column) -> Column:
    return a != b


def _with_states(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``rows`` of transfers with ``outside`` and ``inside``: the state after each row of a
    group that starts outside, or inside, a quoted value.

    A transfer keeps, swaps or fixes the state.  After a row the state is the last fixed
    one, or else the start, turned round by the swaps since.  A fixed state is carried
    with all swaps before it taken back, so that the swaps so far apply to both alike.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)).over(upto) % 2 == 1
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), _xor(F.col("from_outside"), F.col("_swaps")))
    walked = rows.withColumn("_swaps", swaps).withColumn("_fixed", F.last(fixed, ignorenulls=True).over(upto))
    after = {name: _xor(F.coalesce("_fixed", F.lit(start)), F.col("_swaps")) for name, start in (("outside", False), ("inside", True))}
    return walked.withColumns(after).drop("_swaps", "_fixed")


def _before(after: str, start: Column, keys: list[str], order: str) -> Column:
    """The state before each row of a group."""
    return F.coalesce(F.lag(after).over(Window.partitionBy(*keys).orderBy(order)), start)


def _returns(line: Column) -> Column:
    """Whether a line with quotes holds a carriage return but at its end."""
    return F.contains(line, F.lit(QUOTE)) & F.contains(F.substring(line, F.lit(1), F.length(line) - 1), F.lit("\r"))


def over_lines(lines: DataFrame, delimiter: str) -> bool:
    """Whether any record may go over several lines."""
    opens = ends_inside(F.col("line"), delimiter, False) | _returns(F.col("line"))
    return bool(lines.agg(F.max(opens)).first()[0])


def split_states(lines: DataFrame, delimiter: str) -> DataFrame:
    """Stored ``file, block, first, opens, quoted_returns, starts_inside, stays_inside``, a
    row per split.

    ``first`` is the place of the first line that is not blank, ``opens`` tells whether
    any line leaves a quote open.  Splits of files in which none does are outside
    throughout; the others are scanned for their transfers, of lines with quotes only.
    """
    is_blank = ~F.rlike("line", F.lit(r"[^\x00-\x20]"))
    quoted = F.contains("line", F.lit(QUOTE))
    scanned = materialize(
        lines.groupBy("file", "block").agg(
            F.min(F.when(~is_blank, F.col("place"))).alias("first"),
            F.max(ends_inside(F.col("line"), delimiter, False)).alias("opens"),
            F.max(_returns(F.col("line"))).alias("quoted_returns"),
        ),
        "csv-splits",
    )
    open_files = scanned.where("opens").select("file").distinct()
    if open_files.isEmpty():
        return scanned.withColumns({"starts_inside": F.lit(False), "stays_inside": F.lit(False)})
    marks = lines.where(quoted).join(small(open_files), "file", "left_semi").select("file", "block", "place", *_both_ends(F.col("line"), delimiter))
    walked = _with_states(marks, ["file", "block"], "place").groupBy("file", "block")
    transfers = walked.agg(F.max_by("outside", "place").alias("from_outside"), F.max_by("inside", "place").alias("from_inside"))
    whole = scanned.join(transfers, ["file", "block"], "left").withColumns(
        {"from_outside": F.coalesce("from_outside", F.lit(False)), "from_inside": F.coalesce("from_inside", F.lit(True))}
    )
    # A file starts outside.
    states = _with_states(whole, ["file"], "block").withColumn("starts_inside", _before("outside", F.lit(False), ["file"], "block"))
    return materialize(
        states.select("file", "block", "first", "opens", "quoted_returns", "starts_inside", F.col("outside").alias("stays_inside")), "csv-states"
    )


def _chomp(record: Column, line_ending: str | None) -> Column:
    if line_ending is not None:
        return record
    return F.when(F.endswith(record, F.lit("\r")), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)


def _joined(key: str, text: str, separator: str) -> Column:
    """The texts of a group in the order of their keys, put together."""
    listed = F.array_sort(F.collect_list(F.struct(key, text)))
    return F.array_join(F.transform(listed, lambda x: x[text]), separator)


def records(lines: DataFrame, states: DataFrame, delimiter: str, *, line_ending: str | None = None) -> DataFrame:
    """``file, block, place, parts, record, is_first``: one row per record that is not blank.

    ``is_first`` marks the first record of each file.  A value whose quote is never
    closed takes what is left of its file.
    """
    separator = line_ending or "\n"
    firsts = materialize(states.where(F.col("first").isNotNull()).groupBy("file").agg(F.min_by("first", "block").alias("_first")), "csv-firsts")
    mixed = states.where(F.col("opens") | F.col("starts_inside")).select("file", "block", "starts_inside", "stays_inside")
    columns = ["file", "block", "place", "parts", "record"]
    if mixed.isEmpty():
        found = lines.withColumnRenamed("line", "record").select(*columns)
    else:
        mixed = materialize(mixed, "csv-mixed")
        plain = lines.join(small(mixed), ["file", "block"], "left_anti").withColumnRenamed("line", "record")
        inside = lines.join(small(mixed), ["file", "block"]).select("*", *_both_ends(F.col("line"), delimiter))
        own = ["file", "block"]
        numbered = _with_states(inside, own, "place").withColumn("after", F.when(F.col("starts_inside"), F.col("inside")).otherwise(F.col("outside")))
        numbered = numbered.withColumn("before", _before("after", F.col("starts_inside"), own, "place"))
        begun = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        numbered = numbered.withColumn("number", F.sum(F.when(~F.col("before"), 1).otherwise(0)).over(begun))
        together = numbered.groupBy("file", "block", "number").agg(
            F.min("place").alias("place"),
            F.first("parts").alias("parts"),
            _joined("place", "line", separator).alias("record"),
            F.max_by("after", "place").alias("open"),
        )
        together = materialize(together, "csv-records")
        part = F.col("open") | (F.col("number") == 0)
        # Parts of records over the end of a split: two a split at most.
        order = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
        pieces = together.where(part).withColumn("_record", F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(order))
        at = F.struct("block", "number").alias("at")
        stitched = pieces.withColumn("at", at).groupBy("file", "_record").agg(
            F.min("block").alias("block"), F.min_by("place", "at").alias("place"), F.min_by("parts", "at").alias("parts"), _joined("at", "record", separator).alias("record")
        )
        found = plain.select(*columns).unionByName(together.where(~part).select(*columns)).unionByName(stitched.select(*columns))
    found = found.where(F.rlike("record", F.lit(r"[^\x00-\x20]"))).join(small(firsts), "file", "left")
    return found.withColumn("is_first", F.col("place") == F.col("_first")).withColumn("record", _chomp(F.col("record"), line_ending)).drop("_first")


def tokens(record: Column, delimiter: str) -> Column:
    """The values of a record as an array of strings: null where nothing stands, the
    empty string where quotes enclose nothing."""
    d = "\\" + delimiter if not delimiter.isalnum() else delimiter
    # Possessive loops: no backtracking, no recursion, however long a value is.
    value = rf'{d}(?:"[^"]*+(?:""[^"]*+)*+"[^{d}]*+|[^{d}]*+)'
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), record), F.lit(value), F.lit(0))

    def plain(text: Column) -> Column:
        own = F.substring(text, F.lit(2), F.length(text))
        enclosed = (F.length(own) >= 2) & F.startswith(own, F.lit(QUOTE)) & F.endswith(own, F.lit(QUOTE))
        bare = F.replace(F.substring(own, F.lit(2), F.length(own) - 2), F.lit('""'), F.lit('"'))
        return F.when(enclosed, bare).when(own != "", own)

    return F.transform(found, plain)
