"""Deterministic privacy masks; null stays null."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: how much of a phone or account number stays readable
PHONE_HEAD, PHONE_TAIL, LAST_DIGITS = 4, 3, 4


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def hashed(column: Column | str, salt: str, order: str = "suffix") -> Column:
    """SHA-256 hex of the salted value. One salt order per platform, or keys stop matching across tables."""
    c = _c(column).cast("string")
    parts = (c, F.lit(salt)) if order == "suffix" else (F.lit(salt), c)
    return F.sha2(F.concat(*parts), 256)


def email(column: Column | str, salt: str) -> Column:
    """Hash the local part, keep the domain; a value without ``@`` becomes null."""
    c = _c(column)
    parts = F.split(c, "@")
    return F.when(
        c.contains("@"), F.concat(hashed(F.get(parts, F.lit(0)), salt), F.lit("@"), F.get(parts, F.lit(1)))
    )


def phone(column: Column | str) -> Column:
    c = _c(column)
    return F.concat(F.substring(c, 1, PHONE_HEAD), F.lit("***"), F.substring(c, -PHONE_TAIL, PHONE_TAIL))


def last_four(column: Column | str) -> Column:
    """``****`` and the last four characters; a shorter value stays readable, so validate length upstream."""
    return F.concat(F.lit("****"), F.substring(_c(column), -LAST_DIGITS, LAST_DIGITS))


def mask(df: DataFrame, rules: Mapping[str, str], salt: str) -> DataFrame:
    """Apply ``{column: "hash" | "hash_prefix" | "email" | "phone" | "last4"}`` in one projection."""
    build = {
        "hash": lambda c: hashed(c, salt),
        "hash_prefix": lambda c: hashed(c, salt, order="prefix"),
        "email": lambda c: email(c, salt),
        "phone": phone,
        "last4": last_four,
    }
    return df.withColumns({c: build[how](c) for c, how in rules.items() if c in df.columns})


def assert_no_pii(df: DataFrame, forbidden: Iterable[str]) -> DataFrame:
    """Schema guard for published tables."""
    leaked = sorted(set(forbidden) & set(df.columns))
    if leaked:
        raise ValueError(f"columns must not be published: {', '.join(leaked)}")
    return df
