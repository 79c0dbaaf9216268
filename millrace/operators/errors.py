"""Bad rows as data: failing steps mark rows, ``split_errors`` parts them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .envelope import ERROR

# Error classes.
KEY_NOT_FOUND = "KeyNotFound"
EXPECTED_ARRAY = "ExpectedArray"
SCHEMA_MISMATCH = "SchemaMismatch"
UNSUPPORTED_CONVERSION = "UnsupportedConversion"
INVALID_JSON = "InvalidJson"
NOT_FOUND = "NotFound"
UNSUPPORTED_EXTENSION = "UnsupportedExtension"
NO_EXTENSION = "NoExtension"


def mark(df: DataFrame, error: Column) -> DataFrame:
    """Record an error class; the first one a row met is kept.

    The class is emitted by a one-element ``explode``.  A later ``_error IS NULL``
    filter then stays above it: as a plain column it would be pushed down and the
    parse it depends on would run once in the filter and again in the projection.
    """
    if ERROR in df.columns:
        error = F.coalesce(F.col(ERROR), error)
    others = [F.col(c) for c in df.columns if c != ERROR]
    return df.select(*others, F.explode(F.array(error.cast("string"))).alias(ERROR))


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows).  Neighbours of a bad row are unaffected.

    Two lazy filters over one plan.  To land both in a single pass use
    ``sinks.files.write_split``.
    """
    if ERROR not in df.columns:
        return df, df.limit(0).withColumn(ERROR, F.lit(None).cast("string"))
    return df.where(F.col(ERROR).isNull()).drop(ERROR), df.where(F.col(ERROR).isNotNull())
