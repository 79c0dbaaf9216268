"""Records read by another schema than they were written by, and logical types."""

import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.evolution import Incompatible
from millrace.operators.convert import to_record


def record(*fields, name="R", **more):
    return {"type": "record", "name": name, "fields": list(fields), **more}


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


def conformed(spark, payloads, reader, writer=None):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "n int, t string").select("n", F.parse_json("t").alias("data"))
    out = to_record(df, reader, writer=writer).orderBy("n").collect()
    return [r["data"].asDict(recursive=True) if r["data"] is not None else r["_error"] for r in out]


def test_promotions(spark):
    kinds = ["int", "long", "float", "double"]
    for i, written in enumerate(kinds):
        for j, read in enumerate(kinds):
            go = lambda: conformed(spark, [{"v": 7}], record(field("v", read)), record(field("v", written)))  # noqa: B023, E731
            if j >= i:
                assert go() == [{"v": 7}] and type(go()[0]["v"]) is (int if j < 2 else float)
            else:
                with pytest.raises(Incompatible):
                    go()
    assert conformed(spark, [{"v": "aé"}], record(field("v", "bytes")), record(field("v", "string"))) == [{"v": "aé".encode()}]
    for written, read in (("string", "int"), ("boolean", "int"), ("int", "string"), ("int", {"type": "array", "items": "int"})):
        with pytest.raises(Incompatible):
            conformed(spark, [], record(field("v", read)), record(field("v", written)))


def test_fields_by_name_alias_and_default(spark):
    writer = record(field("old", "int"), field("gone", "string"), field("same", "string"))
    reader = record(
        field("same", ["null", "string"]), field("new", "long", aliases=["older", "old"]), field("added", "string", default="d"),
        field("list", {"type": "array", "items": "int"}, default=[1, 2]), field("none", ["null", "int"], default=None),
    )
    got = conformed(spark, [{"old": 1, "gone": "x", "same": "s"}, {"old": "no", "gone": "x", "same": "s"}], reader, writer)
    assert got == [{"same": "s", "new": 1, "added": "d", "list": [1, 2], "none": None}, "SchemaMismatch"]
    with pytest.raises(Incompatible, match="added"):
        conformed(spark, [], record(field("added", "string")), writer)


def test_nested_unions_enums_and_nulls(spark):
    writer = record(
        field("u", ["null", "int", "string"]), field("e", {"type": "enum", "name": "E", "symbols": ["A", "B", "C"]}),
        field("m", {"type": "map", "values": "int"}), field("a", {"type": "array", "items": record(field("x", "int"), name="I")}), field("o", ["null", "long"]),
    )
    reader = record(
        field("u", ["long", "null"]), field("e", {"type": "enum", "name": "E", "symbols": ["A", "B"]}),
        field("m", {"type": "map", "values": "double"}), field("a", {"type": "array", "items": record(field("x", ["string", "double"]), name="I")}), field("o", "long"),
    )
    base = {"u": 5, "e": "A", "m": {"k": 2}, "a": [{"x": 1}, {"x": 2}], "o": 3}
    got = conformed(spark, [base, base | {"u": "text"}, base | {"e": "C"}, base | {"o": None}, base | {"u": None}, base | {"a": []}], reader, writer)
    good = {"u": 5, "e": "A", "m": {"k": 2.0}, "a": [{"x": {"string": None, "double": 1.0}}, {"x": {"string": None, "double": 2.0}}], "o": 3}
    assert got == [good, "SchemaMismatch", "SchemaMismatch", "SchemaMismatch", good | {"u": None}, good | {"a": []}]
    fallback = record(field("e", {"type": "enum", "name": "E", "symbols": ["A"], "default": "A"}))
    assert conformed(spark, [base | {"e": "C"}], fallback, writer) == [{"e": "A"}]
    with pytest.raises(Incompatible):
        conformed(spark, [], record(field("e", {"type": "enum", "name": "Other", "symbols": ["A"]})), writer)
    aliased = record(field("e", {"type": "enum", "name": "Other", "aliases": ["E"], "symbols": ["A", "B", "C"]}))
    assert conformed(spark, [base | {"e": "C"}], aliased, writer) == [{"e": "C"}]


LOGICAL = record(
    field("d", {"type": "int", "logicalType": "date"}), field("ms", {"type": "long", "logicalType": "timestamp-millis"}),
    field("us", {"type": "long", "logicalType": "timestamp-micros"}), field("local", {"type": "long", "logicalType": "local-timestamp-millis"}),
    field("p", {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}), field("id", {"type": "string", "logicalType": "uuid"}),
    field("odd", {"type": "int", "logicalType": "no-such"}), field("n", ["null", {"type": "int", "logicalType": "date"}], default=None),
)
ROW = {"d": 19724, "ms": 1704153600123, "us": 1704153600123456, "local": 1704153600123, "p": 1234.5, "id": "0f8fad5b-d9cb-469f-a165-70867728950e", "odd": 4}


def test_logical_types(spark):
    at = datetime.datetime(2024, 1, 2, 0, 0, 0, 123000)
    good = {
        "d": datetime.date(2024, 1, 2), "ms": at, "us": at.replace(microsecond=123456), "local": at, "p": decimal.Decimal("1234.50"),
        "id": ROW["id"], "odd": 4, "n": None,
    }
    df = spark.createDataFrame([(0, json.dumps(ROW))], "n int, t string").select(F.parse_json("t").alias("data"))
    out = to_record(df, LOGICAL).select("data.*")
    text = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns]).first()
    assert tuple(text) == ("2024-01-02", "2024-01-02 00:00:00.123", "2024-01-02 00:00:00.123456", "2024-01-02 00:00:00.123", "1234.50", ROW["id"], "4", None)
    assert dict(out.dtypes)["local"] == "timestamp_ntz" and dict(out.dtypes)["p"] == "decimal(6,2)"
    assert conformed(spark, [ROW], LOGICAL)[0]["d"] == good["d"]
    misfits = [{"d": "2024"}, {"d": 1.5}, {"ms": 10**18}, {"p": 12345.67}, {"p": 1.005}, {"p": "x"}, {"id": "nope"}, {"us": None}, {"p": True}]
    assert conformed(spark, [ROW | m for m in misfits], LOGICAL) == ["SchemaMismatch"] * len(misfits)
    fits = [{"p": "12.30"}, {"p": 7}, {"p": "1.500"}, {"n": 0}]
    assert "SchemaMismatch" not in conformed(spark, [ROW | m for m in fits], LOGICAL)


def test_logical_types_resolve_to_their_own(spark):
    wider = record(field("p", {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 4}), field("d", {"type": "int", "logicalType": "date"}, default=3), name="R")
    assert conformed(spark, [ROW], wider, LOGICAL) == [{"p": decimal.Decimal("1234.5000"), "d": datetime.date(2024, 1, 2)}]
    narrow = record(field("p", {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 0}))
    assert conformed(spark, [ROW, ROW | {"p": 8}], narrow, LOGICAL) == ["SchemaMismatch", {"p": decimal.Decimal(8)}]
    defaulted = record(field("new", {"type": "int", "logicalType": "date"}, default=3))
    assert conformed(spark, [ROW], defaulted, LOGICAL) == [{"new": datetime.date(1970, 1, 4)}]
    for kind in ({"type": "int"}, {"type": "long", "logicalType": "timestamp-millis"}):
        with pytest.raises(Incompatible):
            conformed(spark, [], record(field("d", kind)), LOGICAL)
