"""Time helpers that do not depend on the session time zone.

The driver tables carry ``timestamp_ntz``. Watermarks need ``timestamp``
(an instant). Converting through epoch microseconds keeps both directions
exact and independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


_SHORT_UNITS = {"us": "microsecond", "ms": "millisecond", "milli": "millisecond", "s": "second", "sec": "second", "secs": "second",
                "m": "minute", "min": "minute", "mins": "minute", "h": "hour", "hr": "hour", "hrs": "hour", "d": "day"}
_PART = r"(?:[+-]?\d+(?:\.\d+)?)\s*(?:[a-zA-Z]+)"


def interval_us(spec: str | int) -> int:
    """'3 seconds' / '500 ms' / '2.5 hours' / '1 hour 30 minutes' -> microseconds.

    The whole text must be numbers with units; anything else is an error."""
    if isinstance(spec, int):
        return spec
    if not re.fullmatch(rf"\s*(?:interval\s+)?(?:{_PART}\s*)+", spec, re.IGNORECASE):
        raise ValueError(f"cannot parse interval {spec!r}")
    total = Fraction(0)
    for num, unit in re.findall(r"([+-]?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", spec):
        u = _SHORT_UNITS.get(unit.lower(), unit.lower().removesuffix("s"))
        if u not in _UNITS_US:
            raise ValueError(f"unknown time unit in {spec!r}")
        total += Fraction(num) * _UNITS_US[u]
    if total.denominator != 1:
        raise ValueError(f"{spec!r} is finer than a microsecond")
    return int(total)


def _is_ntz(df: DataFrame | None, name: str | None) -> bool:
    if df is None or name is None:
        return True
    return isinstance(df.schema[name].dataType, TimestampNTZType)


def epoch_us(c: str | Column, df: DataFrame | None = None) -> Column:
    """Epoch microseconds of a timestamp column (ntz read as UTC wall time)."""
    name = c if isinstance(c, str) else None
    col = F.col(c) if isinstance(c, str) else c
    return _ntz_us(col) if _is_ntz(df, name) else F.unix_micros(col)


def _ntz_us(col: Column) -> Column:
    """From the date and the time parts: a difference of timestamps would go
    through the session's zone and its clock changes."""
    day = F.unix_date(col.cast("date")).cast("long")
    second = (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long")
    return ((day * 24 + F.hour(col)) * 60 + F.minute(col)) * 60_000_000 + second


def time_literal(us: int, df: DataFrame, name: str) -> Column:
    """The instant as a literal of the column's own type (compared with the
    raw column it can be pushed into the scan)."""
    text = (datetime(1970, 1, 1) + timedelta(microseconds=us)).isoformat(sep=" ")
    if _is_ntz(df, name):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    return F.expr(f"TIMESTAMP'{text}+00:00'")


def from_epoch_us(us: Column) -> Column:
    """Epoch microseconds -> timestamp_ntz (UTC wall time)."""
    left = F.pmod(us, F.lit(86_400_000_000))
    day = F.expr(_NTZ_EPOCH) + F.make_dt_interval(days=((us - left) / 86_400_000_000).cast("int"))
    return day + F.make_dt_interval(secs=(left.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)"))


def to_instant(c: str | Column) -> Column:
    """timestamp_ntz (UTC wall time) -> timestamp instant, any session zone."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(_ntz_us(col))


def to_ntz(c: str | Column) -> Column:
    """timestamp instant -> timestamp_ntz (UTC wall time), any session zone."""
    col = F.col(c) if isinstance(c, str) else c
    return from_epoch_us(F.unix_micros(col))


def flatten_window(df: DataFrame, struct_col: str = "window") -> DataFrame:
    """Replace a window struct by ``window_start``, ``window_end`` columns."""
    others = [F.col(f"`{c}`") for c in df.columns if c != struct_col]
    return df.select(
        *others,
        F.col(f"{struct_col}.start").alias("window_start"),
        F.col(f"{struct_col}.end").alias("window_end"),
    )
