"""As-of and range joins without cross products.

``asof`` unions both sides and carries the last quote forward in one window pass: one shuffle on the key, cost
in proportion to both inputs, at any ratio of sizes. ``asof_few`` joins and reduces by an aggregate, for a target
side that is small per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(targets: DataFrame, quotes: DataFrame, keys: Sequence[str], target_time: str, quote_time: str, values: Sequence[str], tolerance_days: int | None = None) -> DataFrame:
    """Each target row with the latest quote at or before its time (quote columns null if none).

    A value named like a column of the targets is an error. A key's rows are one window in one task (sorted and spilled by
    Spark, one row at a time): split a key that holds a large share of all rows by time before. Ties among quotes of one time go to the greatest ``values``. With a tolerance, older quotes count as none.
    """
    clash = {quote_time, *values} & set(targets.columns)
    if clash:
        raise ValueError(f"targets already have {sorted(clash)}")
    payload = F.struct(F.col(quote_time).alias("t"), *[F.col(v) for v in values])
    q = quotes.filter(F.col(quote_time).isNotNull()).select(*keys, F.col(quote_time).alias("__t"), F.lit(0).alias("__side"), payload.alias("__q"), F.lit(None).cast(_row_type(targets)).alias("__row"))
    row = F.struct(*targets.columns)
    t = targets.select(*keys, F.col(target_time).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(q.schema["__q"].dataType).alias("__q"), row.alias("__row"))
    w = Window.partitionBy(*keys).orderBy(F.col("__t").asc_nulls_first(), "__side", F.col("__q").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    filled = q.unionByName(t).withColumn("__last", F.last("__q", ignorenulls=True).over(w)).filter("__side = 1")
    found = F.col("__last")
    if tolerance_days is not None:
        found = F.when(F.datediff(F.col("__t"), F.col("__last.t")) <= tolerance_days, F.col("__last"))
    kept = filled.select("__row.*", found.alias("__found"))
    return kept.select(*targets.columns, F.col("__found.t").alias(quote_time), *[F.col(f"__found.{v}").alias(v) for v in values])


def _row_type(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("r")).schema["r"].dataType


def asof_few(targets: DataFrame, quotes: DataFrame, keys: Sequence[str], target_keys: Sequence[str], target_time: str, quote_time: str, values: Sequence[str]) -> DataFrame:
    """As asof, by equi-join, time bound and an aggregate of the greatest (time, values); unmatched targets are kept.

    ``target_keys`` name a target row. Rows between join and aggregate are targets per key times quotes per key.
    """
    q = quotes.select(*keys, quote_time, *[c for c in values if c not in (*keys, quote_time)])
    cut = targets.select(*dict.fromkeys([*keys, *target_keys, target_time]))
    best = cut.join(q, list(keys)).filter(F.col(quote_time) <= F.col(target_time)).groupBy(*target_keys).agg(F.max(F.struct(quote_time, *values)).alias("__best"))
    return targets.join(best, list(target_keys), "left").select(*targets.columns, F.col(f"__best.{quote_time}").alias(quote_time), *[F.col(f"__best.{v}").alias(v) for v in values])


def implied_period(rows: DataFrame, ends: DataFrame, keys: Sequence[str], date: str, end: str, period: str, out: str = "implied") -> DataFrame:
    """Each row with the least period whose end is at or after its date, by a window over both sides; none for a null date.

    Periods without an end are left out.
    """
    e = ends.filter(F.col(end).isNotNull()).select(*keys, F.col(end).alias("__t"), F.lit(1).alias("__side"), F.col(period).alias("__p"), F.lit(None).cast(_row_type(rows)).alias("__row"))
    r = rows.select(*keys, F.col(date).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(ends.schema[period].dataType).alias("__p"), F.struct(*rows.columns).alias("__row"))
    w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(0, Window.unboundedFollowing)
    return e.unionByName(r).withColumn("__n", F.min("__p").over(w)).filter("__side = 0").select("__row.*", F.when(F.col("__t").isNotNull(), F.col("__n")).alias(out))


def earliest_base(df: DataFrame, keys: Sequence[str], year: str, value: str, back: tuple[int, int] = (5, 3)) -> DataFrame:
    """Each row with the earliest positive value from ``back[0]`` to ``back[1]`` years before: base_year, base_value.

    The years are a range frame of the key's own rows, so no self-join is needed.
    """
    w = Window.partitionBy(*keys).orderBy(year).rangeBetween(-back[0], -back[1])
    base = F.min(F.when(F.col(value) > 0, F.struct(F.col(year).alias("y"), F.col(value).alias("v")))).over(w)
    return df.withColumn("__b", base).select(*df.columns, F.col("__b.y").alias("base_year"), F.col("__b.v").alias("base_value"))


def at_offset(df: DataFrame, keys: Sequence[str], year: str, value: str, offset: int, out: str) -> DataFrame:
    """Each row with the value exactly ``offset`` years away (null in a gap, unlike lag or lead)."""
    w = Window.partitionBy(*keys).orderBy(year).rangeBetween(offset, offset)
    return df.withColumn(out, F.max(value).over(w))


def factor_after(rows: DataFrame, events: DataFrame, keys: Sequence[str], row_keys: Sequence[str], date: str, event_date: str, ratio: str, out: str = "factor") -> DataFrame:
    """Product of the ratios of events strictly after each row's date, 1.0 if none or without a date; ratios of 0 or less are ignored.

    One window over both sides, so the cost is in proportion to both, at any number of events of a key.
    """
    e = events.filter((F.col(ratio) > 0) & F.col(event_date).isNotNull()).select(*keys, F.col(event_date).cast("timestamp").alias("__t"), F.ln(F.col(ratio).cast("double")).alias("__l"), F.lit(0).alias("__side"), F.lit(None).cast(_row_type(rows)).alias("__row"))
    r = rows.select(*keys, F.col(date).cast("timestamp").alias("__t"), F.lit(None).cast("double").alias("__l"), F.lit(1).alias("__side"), F.struct(*rows.columns).alias("__row"))
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("__t"), F.desc("__side")).rowsBetween(Window.unboundedPreceding, 0)
    found = e.unionByName(r).withColumn("__f", F.when(F.col("__t").isNotNull(), F.exp(F.sum("__l").over(w)))).filter("__side = 1")
    return found.select("__row.*", F.coalesce("__f", F.lit(1.0)).alias(out))


def benchmark_return(rows: DataFrame, entry: str, exit_: str, series: DataFrame, date: str, value: str, out: str = "benchmark_return") -> DataFrame:
    """Each row with the return of one series between its two dates, as of each; null where a date or a value is missing.

    Only the distinct dates meet the series (days are bounded), and come back by equality.
    """
    days = rows.select(F.col(entry).alias("__d")).unionByName(rows.select(F.col(exit_).alias("__d"))).filter("__d IS NOT NULL").distinct().withColumn("__k", F.lit(1))
    quotes = series.filter(F.col(value).isNotNull()).select(F.lit(1).alias("__k"), F.col(date).alias("__q"), F.col(value).cast("double").alias("__v"))
    known = asof(days, quotes, ["__k"], "__d", "__q", ["__v"]).select("__d", "__v")
    a, b = known.select(F.col("__d").alias(entry), F.col("__v").alias("__a")), known.select(F.col("__d").alias(exit_), F.col("__v").alias("__b"))
    return rows.join(a, entry, "left").join(b, exit_, "left").withColumn(out, F.when(F.col("__a") != 0, F.col("__b") / F.col("__a") - 1)).select(*rows.columns, out)


def with_fallback(found: DataFrame, value: str, fallback: DataFrame, keys: Sequence[str], fallback_value: str) -> DataFrame:
    """``value`` where present, else the key's fallback value."""
    return found.join(fallback.select(*keys, F.col(fallback_value).alias("__fb")), list(keys), "left").withColumn(value, F.coalesce(value, "__fb")).drop("__fb")


def within(a: DataFrame, b: DataFrame, keys: Sequence[str], matched: Column) -> DataFrame:
    """Rows of ``a`` flagged by whether any row of ``b`` with the same keys meets a residual condition.

    A semi join and an anti join on the keys, which stop at the first hit and share one shuffle; nulls in other columns of ``a``
    mean nothing, a null key is never matched.
    """
    on = matched
    for k in keys:
        b = b.withColumnRenamed(k, f"__{k}")
        on = (F.col(k) == F.col(f"__{k}")) & on
    return a.join(b, on, "left_semi").withColumn("matched", F.lit(True)).unionByName(a.join(b, on, "left_anti").withColumn("matched", F.lit(False)))
