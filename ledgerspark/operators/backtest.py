"""Rule-based portfolios without look-ahead: eligibility, cohorts, curves, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.asof import at_offset
from ledgerspark.operators.dedup import top_n
from ledgerspark.operators.windows import cumulative_product

COMPARISONS = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__, "==": Column.__eq__, "!=": Column.__ne__}


def predicate(rules: Sequence[tuple[str, str, float]]) -> Column:
    """All rules [metric, comparison, threshold] hold; an unknown or NaN value fails, an unknown comparison raises."""
    def one(metric: str, comparison: str, threshold: float) -> Column:
        if comparison not in COMPARISONS:
            raise ValueError(f"unknown comparison {comparison!r}")
        return F.coalesce(COMPARISONS[comparison](F.col(metric), F.lit(threshold)) & ~F.isnan(F.col(metric).cast("double")), F.lit(False))

    return reduce(and_, [one(*r) for r in rules], F.lit(True))


def as_of_date(filed: Column, period_end: Column, lag_days: int = 90) -> Column:
    """When a report could be known: its filing date, else its period's end and a lag."""
    return F.coalesce(filed, F.date_add(period_end, lag_days))


def returns(df: DataFrame, key: str, year: str, price: str) -> DataFrame:
    """``entry, exit, ret``: exit is exactly the next year's entry; rows without one or with a price of 0 or less go."""
    found = at_offset(df.withColumn("entry", F.col(price)), [key], year, "entry", 1, "exit")
    return found.filter((F.col("entry") > 0) & (F.col("exit") > 0)).withColumn("ret", F.col("exit") / F.col("entry") - 1)


def cohorts(df: DataFrame, year: str, rule: Column, rank: Sequence[Column], cap: int = 30) -> DataFrame:
    """Each year's holdings: rows that pass, at most ``cap`` by rank."""
    return top_n(df.filter(rule), [year], rank, cap)


def curve(df: DataFrame, keys: Sequence[str], year: str, ret: str, start: float = 100.0) -> DataFrame:
    """``value`` after each year, ``peak`` so far (the start included) and ``drawdown``."""
    w = Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    valued = df.withColumn("value", start * cumulative_product(1 + F.col(ret), keys, year))
    return valued.withColumn("peak", F.greatest(F.lit(start), F.max("value").over(w))).withColumn("drawdown", F.col("value") / F.col("peak") - 1)


def statistics(df: DataFrame, keys: Sequence[str], year: str, ret: str, risk_free: float = 0.04) -> DataFrame:
    """cagr, max_drawdown, annual_vol, sharpe, n_years; volatility of under two years or of none gives no ratio."""
    c = curve(df, keys, year, ret)
    n, vol = F.count(ret), F.stddev_samp(ret)
    end = F.max_by("value", year)
    return c.groupBy(*keys).agg(
        (F.pow(end / 100.0, 1.0 / n) - 1).alias("cagr"), F.least(F.min("drawdown"), F.lit(0.0)).alias("max_drawdown"), F.when(n >= 2, vol).alias("annual_vol"),
        F.when((n >= 2) & (vol >= 1e-12), (F.avg(ret) - risk_free) / vol).alias("sharpe"), n.alias("n_years"),
    )
