"""Data checks and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def divergence(reported: Column, computed: Column, tolerance: float) -> Column:
    """Whether two values differ by more than a share of the first."""
    return F.abs(reported - computed) > tolerance * F.abs(reported)


def missing(expected: DataFrame, actual: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    return expected.select(*keys).distinct().join(actual.select(*keys), list(keys), "left_anti").withColumn("reason", F.lit(reason))


def staleness(latest: Column, reference: Column) -> Column:
    """missing / stale / fresh against a reference year."""
    return F.when(latest.isNull(), "missing").when(latest < reference, "stale").otherwise("fresh")


def reconcile(a: Column, b: Column, tolerance: float = 0.005, scale: float = 0.5) -> Column:
    """match, sign flip, scale error (a power of ten of at least the given size) or mismatch; null if either is."""
    close = lambda x, y: F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y))
    power = F.round(F.log10(F.abs(a / F.when(b != 0, b))))
    scaled = (F.abs(power) >= scale) & close(F.abs(a), F.abs(b) * F.pow(F.lit(10.0), power))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("string")).when(close(a, b), "match").when(close(a, -b), "sign").when(F.coalesce(scaled & (a != 0), F.lit(False)), "scale").otherwise("mismatch")


def escalate(df: DataFrame, cluster: Sequence[str], key: str, severity: str, least: int = 25) -> DataFrame:
    """``severity`` raised to critical in clusters of ``least`` distinct keys. The cluster's count is an aggregate joined back."""
    sizes = df.groupBy(*cluster).agg(F.count_distinct(key).alias("cluster_size"))
    return df.join(sizes, list(cluster)).withColumn(severity, F.when(F.col("cluster_size") >= least, "critical").otherwise(F.col(severity)))


def cluster_growth(now: DataFrame, before: DataFrame, cluster: Sequence[str], least: int = 5, share: float = 0.2) -> DataFrame:
    """new, grown (by ``least`` and the share at once), worse (a higher ``severity``, where both have one) or steady, against the run before."""
    ranked = "severity" in now.columns and "severity" in before.columns
    j = now.join(before.select(*cluster, F.col("n").alias("before"), *([F.col("severity").alias("__was")] if ranked else [])), list(cluster), "left")
    more = F.col("n") - F.col("before")
    change = F.when(F.col("before").isNull(), "new").when((more >= least) & (more >= share * F.col("before")), "grown")
    if ranked:
        change = change.when(F.col("severity") > F.col("__was"), "worse")
    return j.withColumn("change", change.otherwise("steady")).drop("__was")


def severity(relative: Column, minor: float = 0.02, major: float = 0.10) -> Column:
    """ok, minor, major by a relative difference; null without one."""
    return F.when(F.abs(relative) <= minor, "ok").when(F.abs(relative) <= major, "minor").when(relative.isNotNull(), "major")


def bucket(key: Column, of: int) -> Column:
    """Stable rotation bucket of a key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(of)).cast("long")


def family(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "string" if isinstance(kind, T.StringType) else "other"


def contract_errors(df: DataFrame, contract: Mapping[str, Sequence[str]]) -> list[str]:
    """What a frame lacks against a contract of column to allowed families; further columns are allowed."""
    have = {f.name: family(f.dataType) for f in df.schema.fields}
    found = [f"missing column {c}" for c in contract if c not in have]
    return found + [f"column {c} is {have[c]}, not {'/'.join(kinds)}" for c, kinds in contract.items() if c in have and have[c] not in kinds]
