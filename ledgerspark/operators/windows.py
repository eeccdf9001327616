"""Window measures over a key's ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import growth


def _by(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def yoy(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "yoy_pct") -> DataFrame:
    """Change against the previous row in percent; a missing year is bridged."""
    return df.withColumn(out, growth(value, F.lag(value).over(_by(keys, order))))


def full_mean(value: str, keys: Sequence[str], order: str, n: int) -> Column:
    """Mean of the last ``n`` rows, null until there are ``n`` non-null ones."""
    w = _by(keys, order).rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def nearest(value: Column, keys: Sequence[str], order: str) -> tuple[Column, Column]:
    """The nearest earlier and later non-null values."""
    w = _by(keys, order)
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.first(value, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))


def islands(df: DataFrame, keys: Sequence[str], year: str) -> DataFrame:
    """Runs of consecutive years: keys, first_year, last_year, length."""
    rank = F.row_number().over(_by(keys, year))
    runs = df.select(*keys, year).distinct().withColumn("__island", F.col(year) - rank)
    return runs.groupBy(*keys, "__island").agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count(F.lit(1)).alias("length")).drop("__island")


def streak(df: DataFrame, keys: Sequence[str], year: str, grace: int = 1) -> DataFrame:
    """Length of the run that ends at the key's latest row of all, or up to ``grace`` years before it."""
    anchor = df.groupBy(*keys).agg(F.max(year).alias("anchor"))
    recent = islands(df, keys, year).join(anchor, list(keys)).filter(F.col("last_year") >= F.col("anchor") - grace)
    return recent.groupBy(*keys).agg(F.max("length").alias("streak"))


def sustained(df: DataFrame, keys: Sequence[str], order: str, ok: Column, n: int) -> DataFrame:
    """Keys whose last ``n`` rows exist and all pass."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("__rn", rank).filter(F.col("__rn") <= n).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(ok, F.lit(False)).cast("long")).alias("passed")).filter((F.col("n") == n) & (F.col("passed") == n)).select(*keys)


def cumulative_product(factor: Column, keys: Sequence[str], order: str) -> Column:
    """Running product of positive factors."""
    return F.exp(F.sum(F.ln(factor)).over(_by(keys, order).rowsBetween(Window.unboundedPreceding, 0)))


def own_history_signal(value: str, keys: Sequence[str], order: str, least: int = 3, band: float = 20.0) -> Column:
    """above / below / normal against the mean of all earlier rows; null with fewer than ``least``."""
    w = _by(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    deviation = growth(value, F.avg(value).over(w))
    label = F.when(deviation > band, "above").when(deviation < -band, "below").otherwise("normal")
    return F.when((F.count(value).over(w) >= least) & deviation.isNotNull(), label)


def growth_trend(df: DataFrame, keys: Sequence[str], year: str, value: str, last: int = 5, least: int = 3) -> DataFrame:
    """Mean log growth of consecutive years over the last transitions; gaps and non-positive values are none."""
    w = _by(keys, year)
    step = F.when((F.col(year) - F.lag(year).over(w) == 1) & (F.col(value) > 0) & (F.lag(value).over(w) > 0), F.ln(value) - F.ln(F.lag(value).over(w)))
    frame = w.rowsBetween(1 - last, 0)
    stepped = df.withColumn("__step", step)
    return stepped.withColumn("trend", F.when(F.count("__step").over(frame) >= least, F.avg("__step").over(frame))).drop("__step")


def trailing(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int = 4) -> DataFrame:
    """Sum of each key's last ``n`` rows, where there are ``n``, and its latest value."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    last = df.withColumn("__rn", rank).filter(F.col("__rn") <= n)
    found = last.groupBy(*keys).agg(F.count(value).alias("__n"), F.sum(value).alias("ttm"), F.max(F.when(F.col("__rn") == 1, F.col(value))).alias("latest"))
    return found.filter(F.col("__n") == n).drop("__n")


def downsample(df: DataFrame, keys: Sequence[str], order: str, most: int) -> DataFrame:
    """Every k-th row of each key, and its last, so that about ``most`` remain."""
    w = Window.partitionBy(*keys)
    numbered = df.withColumn("__rn", F.row_number().over(w.orderBy(order))).withColumn("__n", F.count(F.lit(1)).over(w))
    stride = F.ceil(F.col("__n") / F.lit(most))
    return numbered.filter(((F.col("__rn") - 1) % stride == 0) | (F.col("__rn") == F.col("__n"))).drop("__rn", "__n")


def trailing_window(df: DataFrame, keys: Sequence[str], date: str, days: int) -> DataFrame:
    """Rows within ``days`` of the key's latest date."""
    newest = F.max(date).over(Window.partitionBy(*keys))
    return df.withColumn("__max", newest).filter(F.datediff("__max", date) <= days).drop("__max")


def f_score(df: DataFrame, keys: Sequence[str], year: str) -> DataFrame:
    """Nine yes-or-no points from a year and the year before; null without one. An unknown comparison scores 0.

    Needs roa, ocf, net_income, leverage, current_ratio, shares, gross_margin, asset_turnover.
    """
    w = _by(keys, year)
    before = lambda c: F.lag(c).over(w)
    tests = [
        F.col("roa") > 0, F.col("ocf") > 0, F.col("roa") > before("roa"), F.col("ocf") > F.col("net_income"), F.col("leverage") < before("leverage"),
        F.col("current_ratio") > before("current_ratio"), F.col("shares") <= before("shares"), F.col("gross_margin") > before("gross_margin"), F.col("asset_turnover") > before("asset_turnover"),
    ]
    points = sum((F.when(t, 1).otherwise(0) for t in tests), F.lit(0))
    return df.withColumn("f_score", F.when(before(year).isNotNull(), points).cast("long"))
