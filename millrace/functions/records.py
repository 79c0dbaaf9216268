"""Declared record schemas: schema JSON → Spark types and conforming columns.

The declaration uses the public Avro schema JSON.  Conformance needs no codec:
the payload stays a typed struct, which is what columnar files want.  The checks
are SQL expressions generated from the schema once, when the plan is built.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Primitive names of the schema language and their Spark types.
PRIMITIVES: dict[str, T.DataType] = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

# Variant kinds that may be read as each Spark type.
ACCEPTED_KINDS: dict[type[T.DataType], tuple[str, ...]] = {
    T.BooleanType: ("BOOLEAN",),
    T.IntegerType: ("BIGINT",),
    T.LongType: ("BIGINT",),
    T.FloatType: ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    T.DoubleType: ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    T.BinaryType: ("BINARY",),
    T.StringType: ("STRING",),
}

# Logical types, the primitives they annotate and their Spark types.  Any
# other annotation is ignored, as the schema language asks.
LOGICAL: dict[tuple[str, str], T.DataType] = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
    ("string", "uuid"): T.StringType(),
}
UUID = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
# Times outside the years 1 to 9999 are misfits; microseconds.
FIRST_TIME, LAST_TIME = -62_135_596_800_000_000, 253_402_300_799_999_999

MISSING = object()


@dataclass(frozen=True)
class Field:
    name: str
    kind: "Kind"
    default: Any
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Kind:
    """A resolved schema node."""

    shape: str  # "scalar", "record", "map", "array" or "union"
    spark: T.DataType
    nullable: bool
    fields: tuple[Field, ...] = ()
    item: "Kind | None" = None
    symbols: tuple[str, ...] = ()
    logical: str | None = None
    name: str | None = None
    aliases: tuple[str, ...] = ()
    fallback: str | None = None  # the symbol that unknown ones of another schema become


def parse_schema(text: str | dict | list) -> Kind:
    """Schema JSON → resolved node; an unreadable schema raises ``ValueError``."""
    node = text
    if isinstance(text, str):
        try:
            node = json.loads(text)
        except json.JSONDecodeError:
            node = text
    return _resolve(node, {})


def _resolve(node: Any, named: dict[str, Kind], space: str = "") -> Kind:
    """``space`` is the namespace that names inside take where they set none."""
    if isinstance(node, str):
        if node in PRIMITIVES:
            return Kind("scalar", PRIMITIVES[node], node == "null")
        if node in named:
            return named[node]
        raise ValueError(f"unknown type {node!r} in schema")
    if isinstance(node, list):
        branches = [b for b in node if b != "null"]
        if not branches:
            raise ValueError("a union needs a type besides null")
        if len(branches) > 1:
            fields = tuple(Field(_branch_name(b), _resolve(b, named, space), MISSING) for b in branches)
            spark = T.StructType([T.StructField(f.name, f.kind.spark, True) for f in fields])
            return Kind("union", spark, len(branches) < len(node), fields)
        inner = _resolve(branches[0], named, space)
        return replace(inner, nullable=inner.nullable or len(branches) < len(node))
    if not isinstance(node, dict) or "type" not in node:
        raise ValueError("a schema node needs a type")
    name = node["type"]
    space = node.get("namespace", space)
    if name == "record":
        fields = tuple(
            Field(f["name"], _resolve(f["type"], named, space), f.get("default", MISSING), tuple(f.get("aliases", ())))
            for f in node["fields"]
        )
        spark = T.StructType([T.StructField(f.name, f.kind.spark, True) for f in fields])
        found = Kind("record", spark, False, fields)
    elif name == "map":
        item = _resolve(node["values"], named, space)
        found = Kind("map", T.MapType(T.StringType(), item.spark, True), False, item=item)
    elif name == "array":
        item = _resolve(node["items"], named, space)
        found = Kind("array", T.ArrayType(item.spark, True), False, item=item)
    elif name == "enum":
        found = Kind("scalar", T.StringType(), False, symbols=tuple(node["symbols"]), fallback=node.get("default"))
    elif name == "fixed":
        found = _annotated(node, "fixed") or Kind("scalar", T.BinaryType(), False)
    else:
        annotated = _annotated(node, name) if isinstance(name, str) else None
        return annotated or _resolve(name, named, space)
    found = replace(found, name=node.get("name"), aliases=tuple(node.get("aliases", ())))
    if "name" in node:
        named[node["name"]] = found
        if space:
            named[f"{space}.{node['name']}"] = found
    return found


def _annotated(node: dict, primitive: str) -> Kind | None:
    """A node with a logical type, None if it has none that is known and valid."""
    logical = node.get("logicalType")
    if (primitive, logical) in LOGICAL:
        return Kind("scalar", LOGICAL[primitive, logical], False, logical=logical)
    precision, scale = node.get("precision"), node.get("scale", 0)
    valid = isinstance(precision, int) and isinstance(scale, int) and 0 <= scale <= precision and 1 <= precision <= 38
    if primitive in ("bytes", "fixed") and logical == "decimal" and valid:
        return Kind("scalar", T.DecimalType(precision, scale), False, logical=logical)
    return None


def _branch_name(branch: Any) -> str:
    """What a union's branch is called: its own name, or its type."""
    if isinstance(branch, str):
        return branch
    return branch.get("name") or _branch_name(branch["type"])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _default(kind: Kind, value: Any) -> str:
    ddl = kind.spark.simpleString()
    if value is None:
        return f"CAST(NULL AS {ddl})"
    if kind.logical is not None and kind.logical != "uuid":
        return _read(f"parse_json({_quoted(json.dumps(value))})", kind)[0]
    if kind.shape == "scalar" and isinstance(kind.spark, T.StringType | T.BinaryType):
        return f"CAST({_quoted(value)} AS {ddl})"
    if kind.shape == "scalar":
        return f"CAST({json.dumps(value)} AS {ddl})"
    if kind.shape == "union":
        # A default is of the first branch.
        value = {kind.fields[0].name: value}
    return f"from_json({_quoted(json.dumps(value))}, {_quoted(ddl)})"


def _has_kind(value: str, names: tuple[str, ...]) -> str:
    """Whether a variant's type is one of ``names``; type parameters are ignored."""
    listed = ", ".join(_quoted(n) for n in names)
    test = f"schema_of_variant({value}) IN ({listed})"
    if "DECIMAL" in names:
        test += f" OR startswith(schema_of_variant({value}), 'DECIMAL')"
    return f"({test})"


def _read(value: str, kind: Kind, depth: int = 0) -> tuple[str, str]:
    """SQL for (typed value, conforms) of a VARIANT expression that is present."""
    ddl = kind.spark.simpleString()
    if kind.shape == "record":
        found = [_find(value, f.name, False) for f in kind.fields]
        typed, ok = _read_members(value, found, kind, depth)
    elif kind.shape == "map":
        item, item_ok = _read(f"v{depth}", kind.item, depth + 1)
        members = f"try_variant_get({value}, '$', 'map<string,variant>')"
        typed = f"transform_values({members}, (k{depth}, v{depth}) -> {item})"
        ok = f"coalesce(forall(map_values({members}), v{depth} -> {item_ok}), false)"
    elif kind.shape == "array":
        item, item_ok = _read(f"v{depth}", kind.item, depth + 1)
        members = f"try_variant_get({value}, '$', 'array<variant>')"
        typed = f"transform({members}, v{depth} -> {item})"
        ok = f"coalesce(forall({members}, v{depth} -> {item_ok}), false)"
    elif kind.shape == "union":
        # One member per branch; the first branch that conforms is filled.
        read = [_read(value, f.kind, depth) for f in kind.fields]
        members, before = [], []
        for field, (branch, branch_ok) in zip(kind.fields, read):
            taken = " AND ".join([f"coalesce({branch_ok}, false)", *[f"NOT coalesce({b}, false)" for b in before]])
            members.append(f"{_quoted(field.name)}, CASE WHEN {taken} THEN {branch} END")
            before.append(branch_ok)
        typed = f"named_struct({', '.join(members)})"
        ok = "(" + " OR ".join(f"coalesce({b}, false)" for b in before) + ")"
    elif kind.logical is not None:
        typed, ok = _read_logical(value, kind)
    elif isinstance(kind.spark, T.NullType):
        typed, ok = "NULL", f"is_variant_null({value})"
    else:
        typed = f"try_variant_get({value}, '$', '{ddl}')"
        ok = f"{typed} IS NOT NULL AND {_has_kind(value, ACCEPTED_KINDS[type(kind.spark)])}"
        if kind.symbols:
            ok += f" AND {typed} IN ({', '.join(_quoted(s) for s in kind.symbols)})"
        ok = f"({ok})"
    if kind.nullable:
        typed = f"CASE WHEN NOT is_variant_null({value}) THEN {typed} END"
        ok = f"(is_variant_null({value}) OR {ok})"
    return typed, ok


def _read_logical(value: str, kind: Kind) -> tuple[str, str]:
    """The same for logical types: days and times since the epoch as numbers, decimals as
    numbers or text with no more digits than declared."""
    whole, ddl = _has_kind(value, ("BIGINT",)), kind.spark.simpleString()
    if kind.logical == "date":
        typed = f"date_from_unix_date(try_variant_get({value}, '$', 'int'))"
        return typed, f"({typed} IS NOT NULL AND {whole})"
    if kind.logical == "uuid":
        typed = f"try_variant_get({value}, '$', 'string')"
        return typed, f"({_has_kind(value, ('STRING',))} AND coalesce({typed} RLIKE {_quoted(UUID)}, false))"
    if kind.logical == "decimal":
        text = f"try_variant_get({value}, '$', 'string')"
        plain = _quoted(rf"^-?\d+(\.\d{{0,{kind.spark.scale}}}0*)?$")
        fits = f"coalesce({text} RLIKE {plain}, false) AND {_has_kind(value, ('BIGINT', 'DECIMAL', 'STRING'))}"
        typed = f"CASE WHEN {fits} THEN try_cast({text} AS {ddl}) END"
        return typed, f"({typed} IS NOT NULL)"
    number, factor = f"try_variant_get({value}, '$', 'bigint')", 1000 if kind.logical.endswith("millis") else 1
    inside = f"{number} BETWEEN {-(-FIRST_TIME // factor)} AND {LAST_TIME // factor}"
    at = f"timestamp_micros({number} * {factor})"
    if isinstance(kind.spark, T.TimestampNTZType):
        at = f"CAST({at} AS TIMESTAMP_NTZ)"
    typed = f"CASE WHEN {inside} THEN {at} END"
    return typed, f"({typed} IS NOT NULL AND {whole})"


def _read_members(value: str, found: list[str], kind: Kind, depth: int) -> tuple[str, str]:
    columns, checks = [], []
    for member, field in zip(found, kind.fields):
        typed, ok = _read(member, field.kind, depth)
        if field.default is MISSING:
            absent = f"CAST(NULL AS {field.kind.spark.simpleString()})"
            absent_ok = "true" if field.kind.nullable else "false"
        else:
            absent, absent_ok = _default(field.kind, field.default), "true"
        columns.append(f"{_quoted(field.name)}, CASE WHEN {member} IS NOT NULL THEN {typed} ELSE {absent} END")
        checks.append(f"CASE WHEN {member} IS NOT NULL THEN {ok} ELSE {absent_ok} END")
    # Having any declared field proves an object; only a value without one is
    # inspected as a whole.
    present = " OR ".join(f"{m} IS NOT NULL" for m in found) or "false"
    checks.append(f"({present} OR startswith(schema_of_variant({value}), 'OBJECT'))")
    return f"named_struct({', '.join(columns)})", f"coalesce({' AND '.join(checks)}, false)"


def _find(record: str, name: str, hyphens: bool) -> str:
    """Member of an object as VARIANT, NULL when absent.

    With ``hyphens``, members whose name has ``-`` for ``_`` are looked for first,
    later names in key order before earlier ones, then the plain name: the same
    member that renaming all keys would have left, without rebuilding the object.
    """
    names = [name]
    if hyphens and "_" in name:
        spellings = itertools.product(*[("-", "_") if c == "_" else (c,) for c in name])
        names = sorted({"".join(s) for s in spellings} - {name}, reverse=True) + names
    found = ", ".join(f"""try_variant_get({record}, "$['{n}']", 'variant')""" for n in names)
    return found if len(names) == 1 else f"coalesce({found})"


def with_record(
    df: DataFrame, payload: str, schema: Kind, *, hyphens: bool = False, record: str = "_record", ok: str = "_ok"
) -> DataFrame:
    """Add the typed record of a VARIANT column and whether it conforms.

    A required field without a default must be present and of the declared kind;
    an absent field with a default takes it; fields not declared are left out.
    ``hyphens`` lets top-level names be spelled with ``-`` for ``_``.

    Members are taken out in a projection of their own, once each; typing and
    checking then read the small members instead of the whole payload.
    """
    value = f"`{payload}`"
    if schema.shape != "record":
        typed, conforms = _read(value, schema)
        return df.select("*", F.expr(typed).alias(record), F.expr(f"coalesce({conforms}, false)").alias(ok))
    members = [f"_m{i}" for i in range(len(schema.fields))]
    found = [F.expr(_find(value, f.name, hyphens)).alias(m) for m, f in zip(members, schema.fields)]
    typed, conforms = _read_members(value, members, schema, 0)
    staged = df.select("*", *found).select("*", F.expr(typed).alias(record), F.expr(conforms).alias(ok))
    return staged.drop(*members)
