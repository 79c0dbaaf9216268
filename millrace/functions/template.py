"""Templates compiled to Spark expressions.

``{{event.data.user_id}}`` is resolved against the DataFrame's *schema* once,
when the plan is built, so rendering is a ``concat`` of columns and literals that
Catalyst can fold and prune.  A path the event does not have renders as an empty
string, nothing is escaped, and text without a tag is returned as it is.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = re.compile(r"\{\{\{\s*(?P<raw>[^{}]+?)\s*\}\}\}|\{\{\s*(?P<plain>[^{}]+?)\s*\}\}")
_PATH = re.compile(r"[A-Za-z_$][\w$-]*(?:\.(?:[\w$-]+|\[\w+\]))*")

# Envelope fields a template may name under ``event``.
ENVELOPE_FIELDS = ("subject", "data", "id", "timestamp", "task_id", "task_type")


def _segments(path: str) -> list[str]:
    return [s.strip("[]") for s in path.split(".")]


def _variant_path(parts: list[str]) -> str:
    return "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in parts)


def _descend(value: Column, kind: T.DataType, parts: list[str]) -> tuple[Column, T.DataType] | None:
    while parts:
        head, rest = parts[0], parts[1:]
        if isinstance(kind, T.VariantType):
            return F.try_variant_get(value, _variant_path(parts), "string"), T.StringType()
        if isinstance(kind, T.StructType) and head in kind.fieldNames():
            value, kind = value.getField(head), kind[head].dataType
        elif isinstance(kind, T.MapType):
            value, kind = F.element_at(value, F.lit(head)), kind.valueType
        elif isinstance(kind, T.ArrayType) and head.isdigit():
            value, kind = F.get(value, F.lit(int(head))), kind.elementType
        else:
            return None
        parts = rest
    return value, kind


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.VariantType):
        return value.cast("string")
    if isinstance(kind, T.StructType | T.MapType | T.ArrayType):
        return F.to_json(value)
    return value.cast("string")


def _lookup(path: str, schema: T.StructType) -> Column | None:
    parts = _segments(path)
    if parts[0] == "this":
        parts = parts[1:]
    if len(parts) < 2 or parts[0] != "event" or parts[1] not in ENVELOPE_FIELDS:
        return None
    if parts[1] not in schema.fieldNames():
        return None
    found = _descend(F.col(parts[1]), schema[parts[1]].dataType, parts[2:])
    return None if found is None else F.coalesce(_as_text(*found), F.lit(""))


def render(template: str, df: DataFrame | T.StructType) -> Column:
    """One string template → one STRING column."""
    schema = df.schema if isinstance(df, DataFrame) else df
    if "{{" not in template:
        return F.lit(template)
    pieces: list[Column] = []
    position = 0
    for tag in _TAG.finditer(template):
        if tag.start() > position:
            pieces.append(F.lit(template[position : tag.start()]))
        path = tag.group("raw") or tag.group("plain")
        if not _PATH.fullmatch(path):
            raise ValueError(f"only plain paths are supported in templates, got {path!r}")
        found = _lookup(path, schema)
        if found is not None:
            pieces.append(found)
        position = tag.end()
    if "{{" in template[position:]:
        raise ValueError(f"unclosed tag in template {template!r}")
    if position < len(template):
        pieces.append(F.lit(template[position:]))
    if not pieces:
        return F.lit("")
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def render_tree(value: Any, df: DataFrame | T.StructType) -> Column:
    """Render every string inside a nested config value; keys are left alone.

    Objects become structs and arrays become arrays.  Numbers, booleans and
    nulls keep their type.
    """
    if isinstance(value, str):
        return render(value, df)
    if isinstance(value, dict):
        if not value:
            return F.from_json(F.lit("{}"), "map<string,string>")
        return F.struct(*[render_tree(v, df).alias(k) for k, v in value.items()])
    if isinstance(value, list):
        return F.array(*[render_tree(v, df) for v in value])
    if value is None:
        return F.lit(None).cast("string")
    return F.lit(value)
