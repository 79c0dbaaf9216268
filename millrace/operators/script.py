"""Script steps with SQL expressions.

The mode is explicit: ``map``, ``filter``, ``fanout`` or ``envelope``.  Expressions
see the envelope columns, so Catalyst pushes filters and prunes columns through
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import variant_kind


def _column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def script_map(events: DataFrame, data: Column | str) -> DataFrame:
    """Replace the payload; subject and id stay."""
    return events.withColumn("data", _column(data))


def script_filter(events: DataFrame, keep: Column | str) -> DataFrame:
    """Drop events for which the condition is false or NULL."""
    return events.where(_column(keep))


def script_fanout(events: DataFrame, elements: Column | str) -> DataFrame:
    """One event per array element; an empty or NULL array gives none."""
    expanded = events.withColumn("_elements", _column(elements))
    if isinstance(expanded.schema["_elements"].dataType, T.VariantType):
        expanded = expanded.withColumn(
            "_elements", F.try_variant_get("_elements", "$", "array<variant>")
        )
    others = [c for c in events.columns if c != "data"]
    exploded = expanded.select(F.explode("_elements").alias("data"), *others)
    return exploded.select(*events.columns)


def script_envelope(events: DataFrame, edit: Column | str) -> DataFrame:
    """Edit the envelope with a result holding ``subject``, ``data`` and maybe ``id``.

    A subject that is not a string leaves the old one; an id that is absent or
    not a string becomes NULL.  A JSON result without both members is no envelope: it
    is the new payload, and subject and id stay.  Payload columns the edit passes on
    untouched stay typed columns.
    """
    edited = events.withColumn("_edit", _column(edit))
    kind = edited.schema["_edit"].dataType
    result = F.col("_edit")
    if isinstance(kind, T.VariantType):
        data = F.try_variant_get(result, "$.data", "variant")
        whole = F.try_variant_get(result, "$.subject", "variant").isNull() | data.isNull()
        return edited.withColumns(
            {
                "subject": F.when(whole, F.col("subject")).otherwise(
                    F.coalesce(_variant_string(result, "subject"), F.col("subject"))
                ),
                "id": F.when(whole, F.col("id")).otherwise(_variant_string(result, "id")),
                "data": F.when(whole, result).otherwise(data),
            }
        ).drop("_edit")
    if not isinstance(kind, T.StructType) or not {"subject", "data"} <= set(kind.fieldNames()):
        raise ValueError("an envelope edit needs both subject and data")
    names = kind.fieldNames()
    subject = _own_string(result, kind, "subject") if "subject" in names else None
    new_id = _own_string(result, kind, "id") if "id" in names else None
    return edited.withColumns(
        {
            "subject": F.coalesce(subject, F.col("subject")) if subject is not None else F.col("subject"),
            "id": F.lit(None).cast("string") if new_id is None else new_id,
            "data": result["data"],
        }
    ).drop("_edit")


def _own_string(result: Column, kind: T.StructType, name: str) -> Column | None:
    inner = kind[name].dataType
    if isinstance(inner, T.StringType):
        return result[name]
    if isinstance(inner, T.VariantType):
        return F.when(
            variant_kind(result[name]) == "STRING", F.try_variant_get(result[name], "$", "string")
        )
    return None


def _variant_string(result: Column, name: str) -> Column:
    value = F.try_variant_get(result, f"$.{name}", "variant")
    return F.when(variant_kind(value) == "STRING", F.try_variant_get(result, f"$.{name}", "string"))
