"""Read-model pieces: layout of statement rows, shares of a total, series with an anchor, manifests, snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.dedup import top_n
from ledgerspark.operators.reshape import anchored

STYLED = ("grand-total", "headline", "subtotal")


def row_class(statement: Column, concept: Column, label: Column, grand: Sequence[str], headline: Sequence[tuple[str, str]], sub: Sequence[str]) -> Column:
    """grand-total, headline, subtotal (by name, or a label that begins 'Total ') or '', the first that holds."""
    is_head = F.lit(False)
    for s, c in headline:
        is_head = is_head | ((statement == s) & (concept == c))
    return F.when(concept.isin(*grand), "grand-total").when(is_head, "headline").when(concept.isin(*sub) | F.startswith(label, F.lit("Total ")), "subtotal").otherwise("")


def indent(section: Column, group: Column, row: Column) -> Column:
    """1 within a group that is not the section itself, unless the row is styled."""
    inner = F.coalesce(group != "", F.lit(False)) & ~group.eqNullSafe(section)
    return F.when(inner & ~row.isin(*STYLED), 1).otherwise(0)


def error_category(message: Column, rules: Mapping[str, str]) -> Column:
    """The category of the first pattern (in any case) that a message holds; else 'other'; null for none."""
    found = F.when(message.isNull(), F.lit(None).cast("string"))
    for pattern, category in rules.items():
        found = found.when(message.rlike(f"(?i){pattern}"), F.lit(category))
    return found.otherwise("other")


def filled(column: str, keys: Sequence[str]) -> Column:
    """One non-null value of the whole partition, the greatest, so that reruns agree."""
    return F.max(column).over(Window.partitionBy(*keys))


def units(df: DataFrame, metric: str, unit: str) -> DataFrame:
    """One unit per metric, the least."""
    return df.groupBy(metric).agg(F.min(unit).alias(unit))


def shares_of(df: DataFrame, keys: Sequence[str], name: str, period: str, value: str, total: str) -> DataFrame:
    """Lines of each key's latest period in percent of its ``total`` line; null without one or where it is 0. An aggregate joined by a window."""
    newest = F.max(period).over(Window.partitionBy(*keys))
    latest = df.withColumn("__n", newest).filter(F.col(period) == F.col("__n")).drop("__n")
    whole = F.max(F.when(F.col(name) == total, F.col(value))).over(Window.partitionBy(*keys))
    return latest.withColumn("pct", F.when(whole != 0, F.col(value) / whole * 100))


def events_like(df: DataFrame, key: str, names: str, dates: str, wanted: Sequence[str], most: int = 3) -> DataFrame:
    """Of two parallel arrays per key: names that share a word with ``wanted``, with ``n`` and ``last`` date, the ``most`` most frequent."""
    pairs = df.select(key, F.explode(F.arrays_zip(F.col(names).alias("name"), F.col(dates).alias("date"))).alias("p")).select(key, "p.name", "p.date")
    sums = pairs.groupBy(key, "name").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last"))
    like = F.arrays_overlap(F.split(F.lower("name"), r"\W+"), F.array(*[F.lit(w.lower()) for w in wanted]))
    return top_n(sums.filter(like), [key], [F.desc("n"), F.desc_nulls_last("last"), F.asc("name")], most)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank percentiles p50, p95, p99 and the like; nothing is interpolated."""
    return df.groupBy(*keys).agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{value}`)").alias(f"p{round(p * 100)}") for p in shares])


def manifest(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Per key the rows and the least and greatest period."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min(period).alias("first"), F.max(period).alias("last"))


def snapshot(df: DataFrame, key: str, date: str, today: Column) -> DataFrame:
    """One row: rows, distinct keys, the latest date and its age in days, from one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.max(date).alias("latest")).withColumn("age_days", F.datediff(today, "latest"))


def with_anchor(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], year: str, value: str) -> DataFrame:
    """``forecast`` (keys, horizon, value) with the latest actual value as horizon 0 before it; keys without a forecast get none."""
    newest = actual.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, year).alias(value))
    start = newest.join(forecast.select(*keys).distinct(), list(keys), "left_semi").withColumn("horizon", F.lit(0).cast("long"))
    return start.select(*keys, "horizon", value).unionByName(forecast.select(*keys, F.col("horizon").cast("long").alias("horizon"), value))


def history(df: DataFrame, key: str, name: str, year: str, value: str, names: Sequence[str], years: int) -> DataFrame:
    """The last ``years`` years of each key, one column per metric."""
    w = Window.partitionBy(key).orderBy(F.desc(year))
    recent = df.withColumn("__r", F.dense_rank().over(w)).filter(F.col("__r") <= years)
    return recent.groupBy(key, year).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def benchmark_cache(df: DataFrame, key: str, group: str, name: str, year: str, value: str, last: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Each key's mean over its last years, and the group's median of those means where ``least`` keys have one."""
    w = Window.partitionBy(key, name).orderBy(F.desc(year))
    own = df.filter(F.col(value).isNotNull()).withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= last)
    means = own.groupBy(key, group, name).agg(F.avg(value).alias("mean"))
    return means, means.groupBy(group, name).agg(F.median("mean").alias("median"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def headline(df: DataFrame, keys: Sequence[str], name: str, period: str, value: str, names: Sequence[str]) -> DataFrame:
    """Key figures of each key's latest period of all."""
    return anchored(df, keys, name, period, value, names)
