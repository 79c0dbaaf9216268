"""All registered queries of this subpackage."""

from __future__ import annotations

from . import (  # noqa: F401
    codes,
    embeddings,
    idfiles,
    jaccard,
    language,
    mixing,
    neighbours,
    pages,
    passages,
    quality,
    secrets,
    spelling,
    tokens,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
