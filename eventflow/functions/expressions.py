"""Column expressions shared by operators (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fizzbuzz(n: str | Column) -> Column:
    """Guards in order: both 3 and 5, then 3, then 5, else the number as text."""
    c = F.col(n) if isinstance(n, str) else n
    return (F.when((c % 3 == 0) & (c % 5 == 0), F.lit("fizzbuzz"))
            .when(c % 3 == 0, F.lit("fizz"))
            .when(c % 5 == 0, F.lit("buzz"))
            .otherwise(c.cast("string")))


def entity_id(kind: str, ident: Column | str, nickname: Column | str | None = None) -> Column:
    """``kind|id|nickname``; the nickname part is left out when not given."""
    parts = [F.lit(kind), F.col(ident) if isinstance(ident, str) else ident]
    if nickname is not None:
        parts.append(F.col(nickname) if isinstance(nickname, str) else nickname)
    return F.concat_ws("|", *parts)


def warn_message(user: str, quantity: str, sku: str, threshold: Column | str) -> Column:
    """Text of a purchase warning built from row fields."""
    th = F.col(threshold) if isinstance(threshold, str) else threshold
    return F.format_string(
        "large order: %s of %s by user %s (limit %s)",
        F.col(quantity).cast("string"), F.col(sku).cast("string"),
        F.col(user).cast("string"), th.cast("string"))


def share_percent(part: Column, other: Column) -> Column:
    """part * 100.0 / (part + other) as double."""
    return (part.cast("double") * F.lit(100.0)) / (part + other).cast("double")
