"""Requests to be sent, and the responses that came back, as tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload as P
from ..functions.template import render, render_tree
from . import errors

# Request methods and payload encodings.
METHODS = ("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD")
SEND_AS = ("Json", "UrlEncoded", "QueryParams")


def _form_encoded(value: Column, kind: T.DataType) -> Column:
    """``k=v&…`` with form escaping; NULL when a member is not a scalar."""
    if isinstance(kind, T.StructType):
        if any(isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType) for f in kind.fields):
            return F.lit(None).cast("string")
        pairs = [
            F.when(
                value[f.name].isNotNull(),
                F.concat(
                    F.url_encode(F.lit(f.name)), F.lit("="), F.url_encode(value[f.name].cast("string"))
                ),
            )
            for f in kind.fields
        ]
        return F.concat_ws("&", *pairs)
    members = F.try_variant_get(value, "$", "map<string,variant>")
    pairs = F.transform(
        F.map_entries(F.map_filter(members, lambda _, v: ~F.is_variant_null(v))),
        lambda e: F.concat(
            F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"].cast("string"))
        ),
    )
    nested = F.exists(F.map_values(members), lambda v: P.variant_kind(v).isin("OBJECT", "ARRAY"))
    return F.when(~nested, F.array_join(pairs, "&"))


def render_requests(events: DataFrame, config: dict[str, Any]) -> DataFrame:
    """One request row per event: method, endpoint, headers, body.

    Payload source in order: ``from_event``, ``object``, ``input``; a payload
    block naming none of them is a configuration error.
    """
    method = config.get("method", "GET")
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    headers = config.get("headers") or {}
    rendered_headers = (
        F.create_map(*[c for k, v in headers.items() for c in (F.lit(k), render(v, events))])
        if headers
        else F.from_json(F.lit("{}"), "map<string,string>")
    )
    out = events.withColumns(
        {
            "method": F.lit(method),
            "endpoint": render(config["endpoint"], events),
            "headers": rendered_headers,
            "body": F.lit(None).cast("string"),
        }
    )
    payload = config.get("payload")
    if payload is None:
        return out
    send_as = payload.get("send_as", "Json")
    if send_as not in SEND_AS:
        raise ValueError(f"unknown encoding {send_as!r}")
    if payload.get("from_event"):
        source = F.col("data")
    elif payload.get("object") is not None:
        source = render_tree(payload["object"], events)
    elif payload.get("input") is not None:
        out = P.with_json(out, "_payload", render(payload["input"], events))
        source = F.col("_payload")
    else:
        raise ValueError("a payload needs from_event, object or input")
    out = out.withColumn("_payload", source)
    kind = out.schema["_payload"].dataType
    if isinstance(kind, T.StringType):
        out = P.with_json_or_string(out, "_payload", F.col("_payload"))
        kind = T.VariantType()
    out = errors.mark(out, F.when(F.col("_payload").isNull(), F.lit(errors.INVALID_JSON)))
    if send_as == "Json":
        return out.withColumn("body", P.to_json_text(F.col("_payload"), kind)).drop("_payload")
    encoded = _form_encoded(F.col("_payload"), kind)
    out = errors.mark(out, F.when(encoded.isNull(), F.lit(errors.UNSUPPORTED_CONVERSION)))
    if send_as == "UrlEncoded":
        return out.withColumn("body", encoded).drop("_payload")
    joiner = F.when(F.contains("endpoint", F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    target = F.when(F.length(encoded) > 0, F.concat("endpoint", joiner, encoded)).otherwise(F.col("endpoint"))
    return out.withColumn("endpoint", target).drop("_payload")


def parse_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Body as JSON, or as a JSON string where it is not JSON; other columns stay."""
    return P.with_json_or_string(responses, "data", F.col(body))


def publish_records(
    events: DataFrame, payload: dict[str, Any], schema: str | dict, *, created_ms: Column | None = None
) -> DataFrame:
    """Render a payload template and resolve it to the topic's declared record.

    ``CreatedDate`` is always set, to now in milliseconds unless given.
    """
    from .convert import to_record

    created = F.unix_millis(F.current_timestamp()) if created_ms is None else created_ms
    fields = [render_tree(v, events).alias(k) for k, v in payload.items() if k != "CreatedDate"]
    record = F.struct(*fields, created.cast("bigint").alias("CreatedDate"))
    return to_record(
        events.withColumn("data", F.to_variant_object(record)), schema, normalize=False
    )
