"""Payload expressions: JSON text, VARIANT and typed structs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare


def with_json(df: DataFrame, name: str, text: Column, otherwise: Column | None = None) -> DataFrame:
    """Add ``name``: ``text`` as VARIANT, or ``otherwise`` where it is not JSON.

    The *whole* text must be one JSON value.  Spark's parser stops after the first
    value (``5 apples`` would be ``5``), so the text is parsed as the first element
    of an array that must still end in a marker no text can know.  The parse is its
    own projection, so it runs once although it is looked at twice.
    """
    prepare(df.sparkSession)
    marker = uuid.uuid4().hex
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{marker}"]')))
    whole = F.try_variant_get("_framed", "$[1]", "string") == marker
    value = F.when(whole, F.try_variant_get("_framed", "$[0]", "variant"))
    if otherwise is not None:
        value = value.otherwise(otherwise)
    return df.withColumn("_framed", framed).withColumn(name, value).drop("_framed")


def with_json_or_string(df: DataFrame, name: str, text: Column) -> DataFrame:
    """As ``with_json``; text that is not JSON is kept as a JSON string."""
    return with_json(df, name, text, otherwise=text.cast("variant"))


def with_reparsed(df: DataFrame, name: str, payload: str) -> DataFrame:
    """A VARIANT column holding a JSON *string* is parsed again; anything else stays."""
    as_text = F.when(
        F.schema_of_variant(payload) == "STRING", F.try_variant_get(payload, "$", "string")
    )
    return with_json(df, name, as_text, otherwise=F.col(payload))


def to_json_text(payload: Column, kind: T.DataType) -> Column:
    """Payload → JSON text.  Absent record fields are written as ``null``."""
    if isinstance(kind, T.StructType | T.MapType | T.ArrayType):
        return F.to_json(payload, {"ignoreNullFields": "false"})
    if isinstance(kind, T.VariantType):
        return F.to_json(payload)
    return F.to_json(payload.cast("variant"))


def to_variant(payload: Column, kind: T.DataType) -> Column:
    """Any payload → VARIANT."""
    if isinstance(kind, T.VariantType):
        return payload
    if isinstance(kind, T.StructType):
        return F.to_variant_object(payload)
    if isinstance(kind, T.MapType | T.ArrayType):
        return F.to_variant_object(payload) if isinstance(kind, T.MapType) else payload.cast("variant")
    return payload.cast("variant")


def variant_kind(payload: Column) -> Column:
    """Leading word of the variant's type: OBJECT, ARRAY, STRING, BIGINT, VOID, …"""
    described = F.schema_of_variant(payload)
    return F.substring_index(F.substring_index(described, "<", 1), "(", 1)


# Members that meet after renaming, sorted by name, plain before renamed and these in key
# order: of each run of equal names the last one stays.  Sorting keeps the work in step
# with the number of members, however many of them meet.
_SORTED = """
CASE WHEN size(array_distinct(_names)) < size(_names) THEN
    array_sort(transform(_names, (n, i) -> struct(n AS name, contains(_keys[i], '-') AS renamed, i AS at))) END
"""

_LAST = "filter(_sorted, (e, i) -> i = size(_sorted) - 1 OR _sorted[i + 1].name <> e.name)"

_NORMALIZED = f"""
CASE WHEN _names IS NULL OR _names = _keys THEN {{payload}}
     WHEN _sorted IS NULL THEN to_variant_object(map_from_arrays(_names, map_values(_map)))
     ELSE to_variant_object(map_from_arrays(transform({_LAST}, e -> e.name), transform({_LAST}, e -> _values[e.at]))) END
"""


def with_normalized_keys(df: DataFrame, name: str, payload: str) -> DataFrame:
    """Add ``name``: the VARIANT column with ``-`` → ``_`` in its top-level keys.

    Nested keys stay, and a payload that is not an object stays.  A renamed key
    replaces a plain key of the same name; of two renamed keys that meet, the later
    one in key order is kept.  The object is opened once, in its own projection,
    and passed on as it came when no key has a hyphen.
    """
    opened = df.withColumn("_map", F.try_variant_get(payload, "$", "map<string,variant>"))
    named = opened.withColumn("_keys", F.map_keys("_map"))
    named = named.withColumn("_names", F.expr("transform(_keys, k -> translate(k, '-', '_'))"))
    met = F.size(F.array_distinct("_names")) < F.size("_names")
    # An explode keeps these from being computed anew for every member.
    named = named.withColumn("_values", F.when(met, F.map_values("_map"))).withColumn("_sorted", F.expr(_SORTED))
    held = named.withColumn("_held", F.explode(F.array(F.struct("_values", "_sorted")))).drop("_values", "_sorted")
    held = held.withColumns({"_values": F.col("_held._values"), "_sorted": F.col("_held._sorted")})
    return held.withColumn(name, F.expr(_NORMALIZED.format(payload=f"`{payload}`"))).drop(
        "_map", "_keys", "_names", "_values", "_sorted", "_held"
    )
