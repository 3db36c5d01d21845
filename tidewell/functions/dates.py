"""Dates and times: formats with % tokens, calendar arithmetic with month-end clamping, whole differences."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import Field, coerce_in, type_of

# Format tokens as Spark patterns, for writing and for reading (single letters read one or two digits).
WRITE = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "DDD"}
READ = {"%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "D"}
UNITS = ("year", "month", "week", "day", "hour", "minute", "second")
SECONDS = {"week": 604800, "day": 86400, "hour": 3600, "minute": 60, "second": 1}


def pattern(tokens: str, table: dict[str, str]) -> str:
    def one(m: re.Match) -> str:
        text = m[0]
        if text in table:
            return table[text]
        if text.startswith("%"):
            raise ValueError(f"format token {text} is not supported")
        return "''" if text == "'" else f"'{text}'" if text.isalpha() else text

    return re.sub(r"%.|[A-Za-z]+|'|.", one, tokens, flags=re.S)


def unit_of(name: str) -> str:
    unit = name.lower().rstrip("s")
    if unit not in UNITS:
        raise ValueError(f"unit {name} is not supported")
    return unit


def moment(df: DataFrame, x: Column) -> Column:
    """Any date, time stamp or ISO text as a time stamp without zone."""
    return coerce_in(df, x, Field("", "DateTime"))


def date_format(df: DataFrame, x: Column, tokens: str) -> Column:
    return F.date_format(moment(df, x), pattern(tokens, WRITE))


def date_parse(text: Column, tokens: str) -> Column:
    """A time stamp, or NULL for what the format can't read. Two-digit years from 69 on are in the last century."""
    found = F.try_to_timestamp(text, F.lit(pattern(tokens, READ))).cast("timestamp_ntz")
    if "%y" not in tokens:
        return found
    return F.when(F.year(found) >= 2069, found - F.expr("interval 100 years")).otherwise(found)


def date_add(df: DataFrame, x: Column, n: Column | int, unit: str) -> Column:
    """The day is clamped to the month's end; a date stays a date unless the unit is one of time."""
    unit, n = unit_of(unit), n if isinstance(n, Column) else F.lit(n)
    zero = F.lit(0)
    if unit in ("year", "month"):
        step = F.make_ym_interval(n if unit == "year" else zero, n if unit == "month" else zero)
    else:
        days = n * 7 if unit == "week" else n if unit == "day" else zero
        step = F.make_dt_interval(days, *(n if unit == u else zero for u in ("hour", "minute", "second")))
    out = moment(df, x) + step
    return out.cast("date") if isinstance(type_of(df, x), T.DateType) and unit in ("year", "month", "week", "day") else out


def _quotient(x: Column, by: int) -> Column:
    """Integer division toward zero."""
    return ((x - x % by) / by).cast("bigint")


def date_diff(df: DataFrame, a: Column, b: Column, unit: str) -> Column:
    """a - b in whole units, toward zero. A month is whole once the clamped anniversary is reached."""
    unit, a, b = unit_of(unit), moment(df, a), moment(df, b)
    if unit in SECONDS:
        micros = F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))
        return _quotient(micros, SECONDS[unit] * 1_000_000)
    months = (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
    anchor = b + F.make_ym_interval(F.lit(0), months)
    whole = months - F.when((a >= b) & (anchor > a), 1).when((a < b) & (anchor < a), -1).otherwise(0)
    return (_quotient(whole, 12) if unit == "year" else whole).cast("bigint")


def to_date(df: DataFrame, x: Column) -> Column:
    return moment(df, x).cast("date")
