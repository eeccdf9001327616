"""Share counts that cannot be: against price, against the other count, and against splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.asof import asof, with_fallback

#: Shares under, assets over and times the price; least count and times the reference; share of the reference and tolerance of a split.
SMALL_SHARES, LARGE_ASSETS, TIMES_PRICE = 2_000_000, 20_000_000, 10.0
LEAST_COUNT, TIMES_REFERENCE = 100_000, 100.0
SHARE_OF_REFERENCE, SPLIT_TOLERANCE = 5.0, 0.30


def as_of_or_latest(rows: DataFrame, quotes: DataFrame, key: str, date: str, quote_date: str, value: str, out: str) -> DataFrame:
    """Each row with the latest value at or before its date, else the key's latest of all."""
    q = quotes.filter(F.col(value).isNotNull()).select(key, F.col(quote_date).alias("__qd"), F.col(value).alias(out))
    newest = q.groupBy(key).agg(F.max_by(out, F.struct("__qd", out)).alias("__latest"))
    return with_fallback(asof(rows, q, [key], date, "__qd", [out]).drop("__qd"), out, newest, [key], "__latest")


def over_price(shares: DataFrame, assets: DataFrame, prices: DataFrame, keys: Sequence[str], key: str = "ticker") -> DataFrame:
    """Few shares with large assets whose assets per share are over ten times the price: ``keys, shares, assets, price, ratio``.

    Takes ``keys, period_end, shares``, ``keys, assets`` and ``key, date, close``.
    """
    base = shares.filter((F.col("shares") > 0) & (F.col("shares") < SMALL_SHARES)).join(assets.filter(F.col("assets") > LARGE_ASSETS), list(keys))
    priced = as_of_or_latest(base.select(*keys, "period_end", "shares", "assets"), prices, key, "period_end", "date", "close", "price").filter("price > 0")
    found = priced.withColumn("ratio", F.col("assets") / F.col("shares") / F.col("price"))
    return found.filter(F.col("ratio") > TIMES_PRICE).select(*keys, "shares", "assets", "price", "ratio")


def _against(counts: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    ref = as_of_or_latest(counts, reference, key, "period_end", "ref_end", "ref_value", "reference")
    return ref.withColumn("ratio", F.when(F.col("reference") > 0, F.col("value") / F.col("reference")))


def too_small_or_large(counts: DataFrame, reference: DataFrame, key: str = "ticker") -> DataFrame:
    """``counts`` (with period_end and value) that are under the floor, or over a hundred times the reference: ``reason``."""
    judged = _against(counts.filter("value IS NOT NULL"), reference, key)
    reason = F.when(F.col("value") < LEAST_COUNT, "floor").when(F.col("ratio") > TIMES_REFERENCE, "times reference")
    return judged.select(*counts.columns, "reference", reason.alias("reason")).filter("reason IS NOT NULL")


def unexplained_small(counts: DataFrame, reference: DataFrame, splits: DataFrame, key: str = "ticker") -> DataFrame:
    """Positive ``counts`` under a fifth of the reference that no split of the key explains: ``reference, ratio``.

    A key's splits are a handful, so they travel as one array.
    """
    small = _against(counts.filter("value > 0"), reference, key).filter(F.col("ratio") < 1 / SHARE_OF_REFERENCE)
    known = splits.filter("ratio IS NOT NULL").groupBy(key).agg(F.collect_set("ratio").alias("__splits"))
    explained = F.exists("__splits", lambda s: F.abs(F.col("ratio") - s) / F.col("ratio") < SPLIT_TOLERANCE)
    return small.join(known, key, "left").filter(~F.coalesce(explained, F.lit(False))).drop("__splits")


def convert(value: Column, currency: Column, to: Column, rate: Column) -> Column:
    """``value`` in another currency: as it is in the same one, times the rate where there is one; a missing rate raises."""
    same = currency == to
    failed = F.raise_error(F.concat(F.lit("no rate from "), F.coalesce(currency, F.lit("?")), F.lit(" to "), F.coalesce(to, F.lit("?")))).cast("double")
    return F.when(same, value).when(rate.isNotNull(), value * rate).otherwise(failed)


def convertible(currency: Column, to: Column, rate: Column) -> Column:
    return F.coalesce(currency == to, F.lit(False)) | rate.isNotNull()


def split_convertible(df: DataFrame, value: str, currency: str, to: str, rate: str) -> tuple[DataFrame, DataFrame]:
    """Converted rows, and those whose rate is missing, so that nothing is passed through unconverted."""
    ok = convertible(F.col(currency), F.lit(to), F.col(rate))
    done = df.filter(ok).withColumn(value, convert(F.col(value), F.col(currency), F.lit(to), F.col(rate))).withColumn(currency, F.lit(to))
    return done, df.filter(~ok)


def lens(df: DataFrame, rates: DataFrame, value: str, currency: str, date: str, to: str = "USD") -> DataFrame:
    """``df`` in one currency at each row's own date; rows without a rate by then stay in theirs.

    ``rates`` has ``base, rate_date, rate`` of the target per unit of base.
    """
    r = asof(df.withColumn("base", F.col(currency)), rates, ["base"], date, "rate_date", ["rate"])
    ok = convertible(F.col(currency), F.lit(to), F.col("rate"))
    done = r.withColumn(value, F.when(ok, F.when(F.col(currency) == to, F.col(value)).otherwise(F.col(value) * F.col("rate"))).otherwise(F.col(value)))
    return done.withColumn(currency, F.when(ok, F.lit(to)).otherwise(F.col(currency))).drop("base", "rate_date", "rate")
