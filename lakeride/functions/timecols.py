"""Time expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as _dt
import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The producer writes createdAt as yyyy-MM-dd'T'HH:mm:ss.SSS'Z';
# only the first 23 characters are parsed, so the trailing Z is ignored.
CREATED_AT_PARSE_CHARS = 23
CREATED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
CREATED_AT_RENDER = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

AsOf = "str | _dt.datetime | _dt.date | Column | None"


def parse_created_at(text: Column) -> Column:
    """Lenient parse: anything not matching the pattern becomes NULL."""
    return F.try_to_timestamp(F.left(text, F.lit(CREATED_AT_PARSE_CHARS)),
                              F.lit(CREATED_AT_PATTERN)).cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    """date_trunc('hour') keeping the NTZ type."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def ts_lit(value) -> Column:
    """``as_of``-style argument to a TIMESTAMP_NTZ column (None = now)."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def date_of(value) -> Column:
    return F.to_date(ts_lit(value))


def micros(ts: Column) -> Column:
    """Epoch microseconds of an NTZ value (session zone pinned to UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


_UNIT_MICROS = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000,
                "d": 86_400_000_000, "w": 604_800_000_000}
_PART = re.compile(r"(\d+(?:\.\d+)?)(ms|s|m|h|d|w)")


def seconds(duration: str | int | float) -> int:
    """'90s', '5m', '1m30s', '1.5h' or a number of seconds -> whole seconds.

    What is not a whole number of seconds, or no duration, is an error: a
    step or range cut to full seconds would silently change every result.
    """
    text = str(duration).strip().lower()
    if re.fullmatch(r"\d+(\.\d+)?", text):
        us = Decimal(text) * 1_000_000
    elif text and _PART.sub("", text) == "":
        us = sum(Decimal(n) * _UNIT_MICROS[unit] for n, unit in _PART.findall(text))
    else:
        raise ValueError(f"not a duration: {duration!r}")
    if us % 1_000_000:
        raise ValueError(f"not a whole number of seconds: {duration!r}")
    return int(us // 1_000_000)
