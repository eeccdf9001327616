"""Null-aware arithmetic. A missing value is NULL, never NaN; a ratio without a usable denominator is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is NULL or 0."""
    return F.when(col(b) != 0, col(a) / col(b))


def percent(a: Column | str, b: Column | str) -> Column:
    return safe_div(a, b) * 100


def over_positive(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL unless b > 0."""
    return F.when(col(b) > 0, col(a) / col(b))


def zero(x: Column | str) -> Column:
    return F.coalesce(col(x), F.lit(0.0))


def sum_unless_all_null(*xs: Column | str) -> Column:
    """Sum with NULL as 0, but NULL if every term is NULL."""
    present = F.coalesce(*[col(x) for x in xs]).isNotNull()
    total = zero(xs[0])
    for x in xs[1:]:
        total = total + zero(x)
    return F.when(present, total)


def clamp(x: Column | str, most: float) -> Column:
    """NULL where the absolute value is over ``most``."""
    return F.when(F.abs(col(x)) <= most, col(x))


def growth(now: Column | str, before: Column | str) -> Column:
    """Change in percent of the earlier value's magnitude."""
    return F.when(col(before) != 0, (col(now) - col(before)) / F.abs(col(before)) * 100)


def nan_to_null(x: Column | str) -> Column:
    return F.when(~F.isnan(col(x)), col(x))


def passes(*conditions: Column) -> Column:
    """Conjunction in which an unknown condition fails."""
    result = F.lit(True)
    for c in conditions:
        result = result & F.coalesce(c, F.lit(False))
    return result
