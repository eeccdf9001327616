"""Screens, bands, signals and peer statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Between optional bounds; null fails once a bound is set."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(column) >= low)
    if high is not None:
        ok = ok & (F.col(column) <= high)
    return F.coalesce(ok, F.lit(False))


def scope(df: DataFrame, equal: Mapping[str, Sequence[str]] | None = None, search: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows whose columns have one of the given values, and of which some column contains the search text in any case."""
    for column, values in (equal or {}).items():
        df = df.filter(F.col(column).isin(*values))
    if search:
        text, columns = search
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.coalesce(F.contains(F.upper(c), F.lit(text.upper())), F.lit(False))
        df = df.filter(hit)
    return df


def band(column: str, bands: Sequence[tuple[str, float | None, float | None]]) -> Column:
    """Label of the half-open band [low, high) that a value is in; null and values in none give null."""
    label = F.when(F.col(column).isNull(), F.lit(None).cast("string"))
    for name, low, high in bands:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(column) >= low)
        if high is not None:
            inside = inside & (F.col(column) < high)
        label = label.when(inside, F.lit(name))
    return label


def bands_for(metric: str, unit: str | None, bands: Mapping[str, Sequence[tuple[str, float | None, float | None]]]) -> Sequence[tuple[str, float | None, float | None]]:
    """The bands of a metric: by its exact name, its name before ' — ' or ' (', the longest prefix that is listed as 'prefix*', or its unit as 'unit:%'."""
    base = metric.split(" — ")[0].split(" (")[0]
    prefixes = sorted((k for k in bands if k.endswith("*") and metric.startswith(k[:-1])), key=len, reverse=True)
    found = next((k for k in (metric, base, *prefixes, f"unit:{unit}") if k in bands), None)
    return bands[found] if found else ()


def in_bands(column: str, bands: Sequence[tuple[str, float | None, float | None]], chosen: Sequence[str]) -> Column:
    """Whether a value is in any chosen band; with none chosen all rows pass, else null fails."""
    return F.coalesce(band(column, bands).isin(*chosen), F.lit(False)) if chosen else F.lit(True)


def traffic_light(value: Column, good: float, bad: float) -> Column:
    """green / yellow / red; ``good`` over ``bad`` means that higher is better."""
    if good >= bad:
        return F.when(value >= good, "green").when(value <= bad, "red").when(value.isNotNull(), "yellow")
    return F.when(value <= good, "green").when(value >= bad, "red").when(value.isNotNull(), "yellow")


def peer_medians(df: DataFrame, key: str, groups: Sequence[str], value: str, least: int = 3) -> DataFrame:
    """``basis, peer_median, peers``: the median of the first group (finest first) with ``least`` known values.

    Each group is one aggregate joined back, so no row meets its peers one by one.
    """
    found = df
    for g in groups:
        stats = df.groupBy(g).agg(F.median(value).alias(f"__m_{g}"), F.count(value).alias(f"__n_{g}"))
        found = found.join(stats, g, "left")
    enough = lambda g: F.col(f"__n_{g}") >= least
    basis = F.coalesce(*[F.when(enough(g), F.lit(g)) for g in groups])
    pick = lambda p: F.coalesce(*[F.when(enough(g), F.col(f"{p}{g}")) for g in groups])
    return found.select(*df.columns, basis.alias("basis"), pick("__m_").alias("peer_median"), pick("__n_").alias("peers"))


def gated(df: DataFrame, group: str, value: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Groups with their median and number of known values where these are ``least`` or more, and one row that counts the hidden ones."""
    stats = df.groupBy(group).agg(F.median(value).alias("median"), F.count(value).alias("n"))
    return stats.filter(F.col("n") >= least), stats.agg(F.count_if(F.col("n") < least).alias("hidden_groups"), F.coalesce(F.sum(F.when(F.col("n") < least, F.col("n"))), F.lit(0)).alias("hidden_rows"))


def compare_one(df: DataFrame, key: str, groups: Sequence[str], value: str, one: object, basis: str | None = None, least: int = 3) -> DataFrame:
    """One key beside its peers: value, median and number of the first group with ``least`` values, or of a forced one (null under it)."""
    return peer_medians(df, key, [basis] if basis else groups, value, least).filter(F.col(key) == F.lit(one))


def mode(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each group, the least of ties."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias("mode"))


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page in a total order."""
    return df.orderBy(*order).offset(number * size).limit(size)


def counted_page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> tuple[DataFrame, int]:
    """One page, and how many rows there are in all."""
    return page(df, order, number, size), df.count()


def fill_rate(df: DataFrame, name: str, key: str) -> DataFrame:
    """Share of all keys that have each name."""
    total = df.agg(F.count_distinct(key).alias("of"))
    return df.groupBy(name).agg(F.count_distinct(key).alias("n")).crossJoin(F.broadcast(total)).withColumn("fill_rate", F.col("n") / F.col("of"))


def recent_fill_rate(df: DataFrame, name: str, key: str, year: str, years: int) -> DataFrame:
    """``n, of, fill_rate`` over all years, and ``recent_n, recent_of, recent_rate`` over the last years of all, from one pass and one row of totals."""
    newest = df.agg(F.max(year).alias("__y"))
    own = df.crossJoin(F.broadcast(newest)).withColumn("__k", F.when(F.col(year) > F.col("__y") - years, F.col(key)))
    total = own.agg(F.count_distinct(key).alias("of"), F.count_distinct("__k").alias("recent_of"))
    found = own.groupBy(name).agg(F.count_distinct(key).alias("n"), F.count_distinct("__k").alias("recent_n")).crossJoin(F.broadcast(total))
    return found.withColumn("fill_rate", F.col("n") / F.col("of")).withColumn("recent_rate", F.when(F.col("recent_of") > 0, F.col("recent_n") / F.col("recent_of")))


def range_position(value: str, keys: Sequence[str]) -> Column:
    """0 at the key's least value, 1 at its greatest."""
    w = Window.partitionBy(*keys)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return F.when(high > low, (F.col(value) - low) / (high - low))
