"""Choosing rows: one per key by explicit order, several per key, retention, disjoint rejoin.

Every choice ends in a total order given by the caller; nothing relies on row order in storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Spark limits each task's rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by the columns ``by``, nulls least: an aggregate, so no sort."""
    rest = [c for c in df.columns if c not in (*keys, *by)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in (*by, *rest)]).select(df.columns)


def keep_most_complete(df: DataFrame, keys: Sequence[str], fields: Sequence[str], then: Sequence[Column]) -> DataFrame:
    """The row of each key with the most non-null fields."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))
    return top_n(df, keys, [filled.desc(), *then])


def retain_recent(df: DataFrame, keys: Sequence[str], period: str, n: int) -> DataFrame:
    """Rows of the ``n`` greatest distinct periods of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(period))
    return df.withColumn("__r", F.dense_rank().over(w)).filter(F.col("__r") <= n).drop("__r")


def prune_slots(df: DataFrame, keys: Sequence[str], slot: str, n: int) -> DataFrame:
    """Rows whose slot is among the key's ``n`` latest, found on distinct slots and applied as a semi join."""
    slots = top_n(df.select(*keys, slot).distinct(), keys, [F.desc(slot)], n)
    return df.join(slots, [*keys, slot], "left_semi")


def rejoin(df: DataFrame, candidate: Column, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Candidates are reduced to one per key; all other rows pass through."""
    flag = F.coalesce(candidate, F.lit(False))
    return top_n(df.filter(flag), keys, order).unionByName(df.filter(~flag))


def best_priority(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Rows that have their group's least priority."""
    w = Window.partitionBy(*keys)
    return df.withColumn("__p", F.min(priority).over(w)).filter(F.col(priority) == F.col("__p")).drop("__p")
