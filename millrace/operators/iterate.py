"""Fan-out of JSON arrays, at the root or under a top-level key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import errors
from .envelope import ERROR


def iterate(events: DataFrame, key: str | None = None, *, name: str | None = None) -> DataFrame:
    """One event per element; id is dropped and ``name`` becomes the subject.

    Rows without the key, or whose value is not an array, stay as one row marked
    with their error class.  An empty array gives no event.
    """
    kind = events.schema["data"].dataType
    if isinstance(kind, T.VariantType):
        target = F.col("data") if key is None else F.try_variant_get("data", f"$['{key}']", "variant")
        elements = F.try_variant_get(target, "$", "array<variant>")
        absent = errors.INVALID_JSON if key is None else errors.KEY_NOT_FOUND
        error = F.when(target.isNull(), F.lit(absent)).when(
            F.col("_elements").isNull(), F.lit(errors.EXPECTED_ARRAY)
        )
    elif isinstance(kind, T.StructType):
        if key is None:
            raise ValueError("a record cannot be iterated: convert it to json or name a key")
        if key not in kind.fieldNames():
            elements, error = F.lit(None).cast("array<string>"), F.lit(errors.KEY_NOT_FOUND)
        elif isinstance(kind[key].dataType, T.ArrayType):
            elements = F.col("data")[key]
            error = F.when(F.col("_elements").isNull(), F.lit(errors.EXPECTED_ARRAY))
        else:
            elements, error = F.lit(None).cast("array<string>"), F.lit(errors.EXPECTED_ARRAY)
    elif isinstance(kind, T.ArrayType) and key is None:
        elements, error = F.col("data"), F.lit(None).cast("string")
    else:
        raise ValueError("iterate needs a JSON payload")

    marked = errors.mark(events.withColumn("_elements", elements), error)
    # A bad row contributes one NULL element so it survives the generator, and a
    # good one exactly its own elements.
    one_null = F.array(F.lit(None).cast(marked.schema["_elements"].dataType.elementType))
    spread = F.when(F.col(ERROR).isNotNull(), one_null).otherwise(F.col("_elements"))
    others = [c for c in marked.columns if c not in ("data", "_elements", "id", "subject")]
    subject = F.col("subject") if name is None else F.when(
        F.col(ERROR).isNull(), F.lit(name)
    ).otherwise(F.col("subject"))
    return marked.select(
        F.explode(spread).alias("data"),
        subject.alias("subject"),
        F.when(F.col(ERROR).isNotNull(), F.col("id")).alias("id"),
        *others,
    )
