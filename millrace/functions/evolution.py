"""Records of one schema read by another: the resolution rules of the schema language.

Both schemas are known when the plan is built, so the rules become one SQL expression
over the typed record.  What can never be read (a string as a number, a field that is
neither written nor has a default) fails then; what depends on the value (a union's
branch, an enum's symbol, a null) is a misfit of its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import MISSING, Field, Kind, _default, _quoted

# What a number of a kind may also be read as.
PROMOTIONS: dict[type[T.DataType], tuple[type[T.DataType], ...]] = {
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.StringType: (T.BinaryType,),
    T.BinaryType: (T.StringType,),
}


class Incompatible(ValueError):
    """Two schemas of which no value of the one can be read as the other."""


def _names(kind: Kind) -> set[str]:
    return {kind.name.rpartition(".")[2]} if kind.name else set()


def _same_name(writer: Kind, reader: Kind) -> bool:
    """Named types match by their own name or an alias of the reader."""
    mine = _names(reader) | {alias.rpartition(".")[2] for alias in reader.aliases}
    return not _names(writer) or not mine or bool(_names(writer) & mine)


def _scalar(value: str, writer: Kind, reader: Kind) -> tuple[str, str]:
    ddl = reader.spark.simpleString()
    if reader.symbols or writer.symbols:
        if not (reader.symbols and writer.symbols and _same_name(writer, reader)):
            raise Incompatible("an enum is read by an enum of its name")
        known = f"{value} IN ({', '.join(map(_quoted, reader.symbols))})"
        if reader.fallback is None:
            return value, known
        return f"CASE WHEN {known} THEN {value} ELSE {_quoted(reader.fallback)} END", "true"
    if writer.logical == "decimal" and reader.logical == "decimal":
        exact = f"try_cast({value} AS {ddl})"
        return exact, f"coalesce({exact} = {value}, false)"
    if writer.logical != reader.logical and not {writer.logical, reader.logical} <= {None, "uuid"}:
        raise Incompatible(f"{writer.logical or 'a plain value'} is not {reader.logical or 'a plain value'}")
    if type(writer.spark) is type(reader.spark):
        return value, "true"
    if type(reader.spark) not in PROMOTIONS.get(type(writer.spark), ()):
        raise Incompatible(f"{writer.spark.simpleString()} is not read as {ddl}")
    if isinstance(writer.spark, T.BinaryType):
        text = f"CASE WHEN is_valid_utf8(CAST({value} AS STRING)) THEN CAST({value} AS STRING) END"
        return text, f"is_valid_utf8(CAST({value} AS STRING))"
    return f"CAST({value} AS {ddl})", "true"


def _member(value: str, name: str) -> str:
    return f"{value}.`{name.replace('`', '``')}`"


def _written_as(writer: Kind, field: Field) -> Field | None:
    """The writer's field of a reader's field: by its name, or by the first alias."""
    written = {f.name: f for f in writer.fields}
    return next((written[name] for name in (field.name, *field.aliases) if name in written), None)


def _record(value: str, writer: Kind, reader: Kind, depth: int) -> tuple[str, str]:
    if not _same_name(writer, reader):
        raise Incompatible(f"record {writer.name!r} is not {reader.name!r}")
    members, checks = [], []
    for field in reader.fields:
        source = _written_as(writer, field)
        if source is not None:
            typed, ok = evolve(_member(value, source.name), source.kind, field.kind, depth)
        elif field.default is not MISSING:
            typed, ok = _default(field.kind, field.default), "true"
        else:
            raise Incompatible(f"field {field.name!r} is neither written nor has a default")
        members.append(f"{_quoted(field.name)}, {typed}")
        checks.append(ok)
    return f"named_struct({', '.join(members)})", "(" + " AND ".join(checks or ["true"]) + ")"


def _into_union(value: str, writer: Kind, reader: Kind, depth: int) -> tuple[str, str]:
    """The first branch that can read the writer's kind is filled: the same kind before
    one that a number is promoted to."""
    found = []
    for place, branch in enumerate(reader.fields):
        try:
            typed, ok = evolve(value, writer, branch.kind, depth)
        except Incompatible:
            continue
        found.append((type(branch.kind.spark) is not type(writer.spark), place, typed, ok))
    if not found:
        raise Incompatible("no branch of the union reads it")
    _, chosen, typed, ok = min(found)
    members = [
        f"{_quoted(b.name)}, {typed if place == chosen else f'CAST(NULL AS {b.kind.spark.simpleString()})'}" for place, b in enumerate(reader.fields)
    ]
    return f"named_struct({', '.join(members)})", ok


def _from_union(value: str, writer: Kind, reader: Kind, depth: int) -> tuple[str, str]:
    """Whichever branch was written; one that the reader cannot read is a misfit."""
    typed, ok, readable = f"CAST(NULL AS {reader.spark.simpleString()})", "false", False
    for branch in reversed(writer.fields):
        member = _member(value, branch.name)
        try:
            branch_typed, branch_ok = evolve(member, branch.kind, reader, depth)
            readable = True
        except Incompatible:
            branch_typed, branch_ok = f"CAST(NULL AS {reader.spark.simpleString()})", "false"
        typed = f"CASE WHEN {member} IS NOT NULL THEN {branch_typed} ELSE {typed} END"
        ok = f"CASE WHEN {member} IS NOT NULL THEN {branch_ok} ELSE {ok} END"
    if not readable:
        raise Incompatible("no branch of the union is read")
    return typed, ok


def evolve(value: str, writer: Kind, reader: Kind, depth: int = 0) -> tuple[str, str]:
    """SQL for (value as the reader has it, it fits) of a typed expression."""
    if writer.shape == "union":
        typed, ok = _from_union(value, writer, reader, depth)
    elif reader.shape == "union":
        typed, ok = _into_union(value, writer, reader, depth)
    elif writer.shape != reader.shape:
        raise Incompatible(f"{writer.shape} is not {reader.shape}")
    elif writer.shape == "record":
        typed, ok = _record(value, writer, reader, depth)
    elif writer.shape == "array":
        item, item_ok = evolve(f"e{depth}", writer.item, reader.item, depth + 1)
        typed, ok = f"transform({value}, e{depth} -> {item})", f"forall({value}, e{depth} -> {item_ok})"
    elif writer.shape == "map":
        item, item_ok = evolve(f"e{depth}", writer.item, reader.item, depth + 1)
        typed = f"transform_values({value}, (k{depth}, e{depth}) -> {item})"
        ok = f"forall(map_values({value}), e{depth} -> {item_ok})"
    else:
        typed, ok = _scalar(value, writer, reader)
    absent = "true" if reader.nullable else "false"
    none = f"CAST(NULL AS {reader.spark.simpleString()})"
    return f"CASE WHEN {value} IS NULL THEN {none} ELSE {typed} END", f"CASE WHEN {value} IS NULL THEN {absent} ELSE coalesce({ok}, false) END"


def with_evolved(df: DataFrame, column: str, writer: Kind, reader: Kind, *, record: str = "_record", ok: str = "_ok") -> DataFrame:
    """Add a typed record of ``writer`` as ``reader`` has it, and whether it fits."""
    typed, fits = evolve(f"`{column}`", writer, reader)
    return df.withColumns({record: F.expr(typed), ok: F.expr(fits)})
