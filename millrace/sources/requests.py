"""Landed HTTP request logs as events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import with_json
from ..functions.auth import Credentials, auth_error


def ingest_requests(
    requests: DataFrame,
    *,
    credentials: Credentials | None = None,
    allow_headers: list[str] | None = None,
    headers: str = "headers",
    body: str = "body",
) -> DataFrame:
    """Judge each request and shape the accepted ones.

    Adds ``auth_error``, ``status`` (200, 400 or 401) and ``data`` =
    {headers, payload}.  Authentication comes before the body; an empty body is
    JSON null; only allow-listed headers are kept.  Header names are lower case; of
    names that differ in case only the last counts.
    """
    lowered = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    own = F.filter(lowered, lambda e: e["key"] == "authorization")
    authorization = F.get(own, F.size(own) - 1)["value"]
    allowed = [F.lit(h.lower()) for h in (allow_headers or [])]
    listed = F.filter(lowered, lambda e: e["key"].isin(*allowed) if allowed else F.lit(False))
    names = F.transform(listed, lambda e: e["key"])
    last = F.filter(listed, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
    kept = F.map_from_entries(last)
    text = F.col(body).cast("string")
    empty = F.coalesce(F.length(text) == 0, F.lit(True))
    # Looked up once; the outcome rules then read the one header.
    judged = requests.withColumn("_authorization", authorization).withColumn(
        "auth_error", auth_error(F.col("_authorization"), credentials)
    )
    # Bodies of rejected requests are not parsed at all.
    wanted = F.when(F.col("auth_error").isNull(), F.when(empty, F.lit("null")).otherwise(text))
    judged = with_json(judged, "_payload", wanted)
    status = (
        F.when(F.col("auth_error").isNotNull(), F.lit(401))
        .when(F.col("_payload").isNull(), F.lit(400))
        .otherwise(F.lit(200))
    )
    return (
        judged.withColumn("status", status)
        .withColumn(
            "data",
            F.when(
                F.col("status") == 200,
                F.struct(kept.alias("headers"), F.col("_payload").alias("payload")),
            ),
        )
        .drop("_payload", "_authorization")
    )
