"""Long to wide, wide to long, resampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def widen(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per name (named lower-case), the greatest value of each cell; absent cells are null."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n.lower()) for n in names])


def lengthen(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], name: str = "metric", value: str = "value") -> DataFrame:
    """One row per non-null cell; ``columns`` maps a column to the name it gets. One pass, no union of scans."""
    cells = F.array(*[F.struct(F.lit(label).alias("n"), F.col(c).cast("double").alias("v")) for c, label in columns.items()])
    return df.select(*keys, F.explode(cells).alias("c")).select(*keys, F.col("c.n").alias(name), F.col("c.v").alias(value)).filter(F.col(value).isNotNull())


def latest_each(df: DataFrame, keys: Sequence[str], name: str, period: str, value: str, names: Sequence[str]) -> DataFrame:
    """Wide table in which each metric comes from its own latest period."""
    return df.groupBy(*keys).agg(*[F.max_by(value, F.when(F.col(name) == n, F.col(period))).alias(n.lower()) for n in names])


def anchored(df: DataFrame, keys: Sequence[str], name: str, period: str, value: str, names: Sequence[str]) -> DataFrame:
    """Wide table in which all metrics come from the key's latest period of all."""
    newest = F.max(period).over(Window.partitionBy(*keys))
    return widen(df.withColumn("__a", newest).filter(F.col(period) == F.col("__a")), [*keys, period], name, value, names)


def resample(df: DataFrame, keys: Sequence[str], time: str, unit: str, value: str, tie: str, carry: Sequence[str] = ()) -> DataFrame:
    """The last value of each period, and the columns ``carry`` of that same row (an average computed before, not anew)."""
    last = df.groupBy(*keys, F.date_trunc(unit, time).alias("period")).agg(F.max_by(F.struct(value, *carry), F.struct(time, tie)).alias("__row"))
    return last.select(*keys, "period", *[F.col(f"__row.{c}").alias(c) for c in (value, *carry)])


def ensure_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Adds the columns that are missing, as typed nulls."""
    return df.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in df.columns])


def with_remainder(df: DataFrame, keys: Sequence[str], name: str, value: str, total: str, least: float = 0.01) -> DataFrame:
    """Parts of a total, and a row 'other' where they leave over ``least`` of it."""
    parts = df.groupBy(*keys).agg(F.sum(value).alias("__sum"), F.max(total).alias(total))
    rest = F.col(total) - F.col("__sum")
    other = parts.filter(rest > F.col(total) * least).select(*keys, F.lit("other").alias(name), rest.alias(value))
    return df.select(*keys, name, value).unionByName(other)


def parse_suffix(label: Column) -> tuple[Column, Column]:
    """('base', 'scenario') of labels like 'base — scenario'; the scenario is null without a suffix."""
    found = F.regexp_extract(label, r"^(.*) — ([^—]+)$", 2)
    base = F.regexp_extract(label, r"^(.*) — ([^—]+)$", 1)
    return F.when(found != "", base).otherwise(label), F.when(found != "", found)
