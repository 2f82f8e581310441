"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole 24-hour periods between two timestamps (not calendar days)."""
    return F.timestamp_diff("DAY", start, end).cast("int")


def whole_days_from_micros(start: Column, end: Column) -> Column:
    return F.floor((end - start) / F.lit(DAY_MICROS)).cast("int")


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """``top / bottom``; ``default`` where the quotient is undefined."""
    quotient = F.try_divide(top.cast("double"), bottom.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def percent(top: Column, bottom: Column) -> Column:
    return ratio(top * F.lit(100.0), bottom)


def no_nan(col: Column) -> Column:
    """One missing value: NaN becomes NULL."""
    return F.nanvl(col, F.lit(None).cast("double"))


def right_closed_bands(value: Column, bands: list[tuple[float | None, str]], low: float) -> Column:
    """Label of the interval ``(previous edge, edge]`` that holds ``value``.

    A value at or under ``low`` has no band; an edge of None is open-ended.
    """
    expr = F.when(value.isNull() | (value <= low), F.lit(None).cast("string"))
    for edge, label in bands:
        expr = expr.when(F.lit(True) if edge is None else value <= edge, F.lit(label))
    return expr


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


# --- report strings -------------------------------------------------------


def plain_number(value: Column, places: int) -> Column:
    """Shortest text of a rounded number, at least one decimal: 24.50 -> 24.5, 24.00 -> 24.0."""
    fixed = F.round(value, places).cast(f"decimal(28,{places})").cast("string")
    trimmed = F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
    # A rounded value of zero keeps no sign.
    return F.regexp_replace(trimmed, r"^-(0\.0)$", "$1")


def money(value: Column, places: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, places))


def percent_text(value: Column, places: int = 1) -> Column:
    return F.concat(F.format_number(value, places), F.lit("%"))


def count_text(value: Column) -> Column:
    return F.format_number(value.cast("double"), 0)
