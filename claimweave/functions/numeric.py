"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimal digits with an optional point, sign and exponent. A cast alone would also take "1d" and "0f".
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def to_number(c: Column) -> Column:
    """Double value of a column that is a number or the text of one, else null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def first_float(*columns: Column, default: float = 0.0) -> Column:
    """First column that reads as a number, else ``default``."""
    return F.coalesce(*[to_number(c) for c in columns], F.lit(default))


def clamp01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def round4(c: Column) -> Column:
    return F.round(c, 4)


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b`` as a double, 0 where ``b`` is zero or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def safe_int(c: Column) -> Column:
    """Whole number or null."""
    return F.trim(c.cast("string")).try_cast("bigint")
