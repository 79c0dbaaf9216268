"""Request authentication as one CASE expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome names and the standard base64 alphabet with padding.
NO_CREDENTIALS = "NoCredentials"
MALFORMED = "MalformedCredentials"
INVALID = "InvalidCredentials"
BASE64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/][AQgw]==|[A-Za-z0-9+/]{2}[AEIMQUYcgkosw048]=)?$"
READABLE = r"^[\t\x20-\x7e]*$"


@dataclass(frozen=True)
class Credentials:
    """Expected credentials; with neither set every request fails."""

    bearer: str | None = None
    username: str | None = None
    password: str | None = None

    @property
    def has_basic(self) -> bool:
        return self.username is not None


def auth_error(authorization: Column, credentials: Credentials | None) -> Column:
    """NULL when accepted, else the failure name.

    A request that presents a bearer token is judged on it alone; basic
    credentials are only looked at when no bearer token was offered or expected.
    """
    if credentials is None:
        return F.lit(None).cast("string")
    outcome = F.when(authorization.isNull(), F.lit(NO_CREDENTIALS)).when(
        ~authorization.rlike(READABLE), F.lit(MALFORMED)
    )
    if credentials.bearer is not None:
        is_bearer = authorization.startswith("Bearer ")
        outcome = outcome.when(
            is_bearer & (F.substring(authorization, 8, 2**31 - 1) == credentials.bearer),
            F.lit(None).cast("string"),
        ).when(is_bearer, F.lit(INVALID))
    if credentials.has_basic:
        is_basic = authorization.startswith("Basic ")
        encoded = F.substring(authorization, 7, 2**31 - 1)
        plain = F.try_to_binary(encoded, F.lit("base64")).cast("string")
        readable = encoded.rlike(BASE64) & F.is_valid_utf8(plain)
        expected = f"{credentials.username}:{credentials.password}"
        outcome = (
            outcome.when(is_basic & ~F.coalesce(readable, F.lit(False)), F.lit(MALFORMED))
            .when(is_basic & (plain == expected), F.lit(None).cast("string"))
        )
    return outcome.otherwise(F.lit(INVALID))
