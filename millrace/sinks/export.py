"""Bulk export of live, or live and deleted, rows to delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import CSV_WRITER

# Operation names, column delimiters and line endings.
OPERATIONS = ("query", "queryAll")
DELIMITERS = {
    "COMMA": ",",
    "TAB": "\t",
    "SEMICOLON": ";",
    "PIPE": "|",
    "CARET": "^",
    "BACKQUOTE": "`",
}
LINE_ENDINGS = {"LF": "\n", "CRLF": "\r\n"}


def bulk_select(df: DataFrame, columns: list[str], operation: str = "query", deleted: str = "is_deleted") -> DataFrame:
    """``query`` leaves deleted rows out, ``queryAll`` keeps them."""
    if operation not in OPERATIONS:
        raise NotImplementedError(f"bulk operation {operation!r}")
    live = df if operation == "queryAll" else df.where(~F.col(deleted))
    return live.select(*columns)


def bulk_export(
    df: DataFrame,
    path: str,
    columns: list[str],
    *,
    operation: str = "query",
    deleted: str = "is_deleted",
    delimiter: str = "COMMA",
    line_ending: str = "LF",
    mode: str = "error",
) -> None:
    """Write the selected rows as CSV with header."""
    (
        bulk_select(df, columns, operation, deleted)
        .write.mode(mode)
        .options(**CSV_WRITER)
        .option("header", True)
        .option("sep", DELIMITERS[delimiter])
        .option("lineSep", LINE_ENDINGS[line_ending])
        .csv(path)
    )
