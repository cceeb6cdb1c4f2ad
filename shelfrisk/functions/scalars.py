"""Column expressions for cleaning readings; a missing value is always NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal numbers, days as text, the amount that stands for a trace of rain, weekend days
# (Sunday is 1) and the weather codes behind each flag.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DAY = r"^\s*([0-9]{4})([-/])([0-9]{1,2})\2([0-9]{1,2})(?![0-9])"
TRACE_CODE = "T"
TRACE_AMOUNT = 0.002
WEEKEND_DAYS = (1, 7)
RAIN_CODES = "ra|dz|sh"
SNOW_CODES = "sn|sg|gs|pl|ic"
STORM_CODES = r"\+fc|fc|ts|gr|sq"


def to_day(c: Column) -> Column:
    """Text that starts with year-month-day or year/month/day, timestamp or date to a date; other text becomes NULL."""
    text = c.cast("string")
    found = [F.regexp_extract(text, DAY, group) for group in (1, 3, 4)]
    return F.when(text.rlike(DAY), F.concat_ws("-", *found).try_cast("date"))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain finite number becomes NULL."""
    text = c.cast("string")
    number = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(is_finite(number), number)


def leading_number(c: Column) -> Column:
    """Number at the start of the text, 0 if there is none (how an untyped store averages text)."""
    text = c.cast("string")
    head = F.regexp_extract(text, r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)", 1)
    return F.when(text.isNotNull(), F.coalesce(head.try_cast("double"), F.lit(0.0)))


def rain_amount(c: Column, trim_trace: bool = False) -> Column:
    """Precipitation text to inches: blank is missing, a trace is a small positive amount.

    The trace code counts only when it stands alone without padding, unless `trim_trace`.
    """
    text = F.nullif(c.cast("string"), F.lit(""))
    code = F.trim(text) if trim_trace else text
    return F.when(code == TRACE_CODE, F.lit(TRACE_AMOUNT)).otherwise(to_number(text))


def is_missing(c: Column) -> Column:
    """NULL or NaN; for a double column."""
    return c.isNull() | F.isnan(c)


def is_finite(c: Column) -> Column:
    """Present, not NaN and not infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def cap_at(value: Column, cap: Column) -> Column:
    """Smaller of the two, NULL if either is missing."""
    return F.when(value.isNotNull() & cap.isNotNull(), F.least(value, cap))


def exceeds(value: Column, cap: Column) -> Column:
    """1 where the value is above the cap, 0 where not, NULL if either is missing."""
    return (value > cap).cast("int")


def is_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit(False))


def has_code(codes: Column, pattern: str) -> Column:
    """Case-insensitive search; a missing text has no code."""
    return F.coalesce(codes.rlike(f"(?i){pattern}"), F.lit(False))


def is_rainy(codes: Column) -> Column:
    return has_code(codes, RAIN_CODES)


def is_snowy(codes: Column) -> Column:
    return has_code(codes, SNOW_CODES)


def is_stormy(codes: Column) -> Column:
    return has_code(codes, STORM_CODES)


def at_least(value: Column, threshold: float) -> Column:
    """1 if the value reaches the threshold, 0 below it or when the value is NaN."""
    return ((value >= threshold) & ~F.isnan(value)).cast("int")


def group_label(c: Column) -> Column:
    """Value as the text label of its group."""
    return c.cast("string")
