"""Table maintenance as transforms: each takes the old state and changes and returns the new state.

A source with repeated keys is an error of the caller, as in a MERGE; ``check_unique`` raises on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if df.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError(f"repeated keys in {list(keys)}")


def _joined(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Full outer join on null-safe keys: structs t and s, null where absent."""
    t = target.select(F.struct(*target.columns).alias("t"))
    s = source.select(F.struct(*target.columns).alias("s"))
    on = None
    for k in keys:
        c = F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
        on = c if on is None else on & c
    t, s = t.withColumn("__t", F.lit(True)), s.withColumn("__s", F.lit(True))
    return t.join(s, on & F.col("__t") & F.col("__s"), "full_outer"), [c for c in target.columns if c not in keys]


def changed(values: Sequence[str], null_safe: bool = False) -> Column:
    """Whether any value differs; unless null-safe, a change from or to null is none."""
    result = F.lit(False)
    for v in values:
        a, b = F.col(f"t.{v}"), F.col(f"s.{v}")
        result = result | (~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False)))
    return result


def classify(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``keys, status``: matched, modified, new (source only) or orphan (target only)."""
    joined, values = _joined(target, source, keys)
    status = F.when(F.col("__t").isNull(), "new").when(F.col("__s").isNull(), "orphan").when(changed(values, null_safe), "modified").otherwise("matched")
    return joined.select(*[F.when(F.col("__s").isNull(), F.col(f"t.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in keys], status.alias("status"))


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update_if: Column | None = None, delete_unmatched: Column | None = None, null_safe: bool = False) -> DataFrame:
    """New state: changed rows are updated (where ``update_if`` holds over structs t and s), new ones inserted, and target
    rows without a source row that meet ``delete_unmatched`` (over t) are deleted."""
    joined, values = _joined(target, source, keys)
    if delete_unmatched is not None:
        joined = joined.filter(~(F.col("__s").isNull() & F.coalesce(delete_unmatched, F.lit(False))))
    take = changed(values, null_safe)
    if update_if is not None:
        take = take & F.coalesce(update_if, F.lit(False))
    use_source = F.col("__t").isNull() | (F.col("__s").isNotNull() & take)
    return joined.select(F.when(use_source, F.col("s")).otherwise(F.col("t")).alias("r")).select("r.*")


def _lacking(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose keys the source has not; null keys are equal."""
    on = None
    for k in keys:
        source = source.withColumnRenamed(k, f"__s_{k}")
        c = F.col(k).eqNullSafe(F.col(f"__s_{k}"))
        on = c if on is None else on & c
    return target.join(source.select(*[f"__s_{k}" for k in keys]).distinct(), on, "left_anti")


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source's rows, and those of the target whose keys it has not."""
    return source.select(target.columns).unionByName(_lacking(target, source, keys))


def delete_orphans(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: Sequence[str], spared: Column | None = None) -> DataFrame:
    """Without target rows that the source lacks, among the scope values that the source covers; rows that ``spared`` holds for stay (derived ones)."""
    flag = F.lit(False) if spared is None else F.coalesce(spared, F.lit(False))
    outside = _lacking(target.filter(~flag), source, scope)
    seen = source.select(*dict.fromkeys([*keys])).distinct()
    both = target.filter(~flag)
    on = None
    for k in keys:
        seen = seen.withColumnRenamed(k, f"__s_{k}")
        c = F.col(k).eqNullSafe(F.col(f"__s_{k}"))
        on = c if on is None else on & c
    held = both.join(seen, on, "left_semi")
    missed = _lacking(outside, source, keys)
    return held.unionByName(missed).unionByName(target.filter(flag))


def preserve(new: Column, old: Column) -> Column:
    """A fresh value where there is one, else the old."""
    return F.coalesce(new, old)


def prune_history(df: DataFrame, keys: Sequence[str], scraped: str, keep: int) -> DataFrame:
    """Rows of the ``keep`` latest loads of each key."""
    from ledgerspark.operators.dedup import retain_recent

    return retain_recent(df, keys, scraped, keep)


def check_scope(scope: DataFrame, present: DataFrame, key: str) -> None:
    """Raise if a write's scope does not cover all keys that are there already: a partial run must not replace a whole table."""
    if present.select(key).distinct().join(scope.select(key), key, "left_anti").limit(1).count():
        raise ValueError(f"the scope lacks some {key} that the table has")


def guard(part: int, whole: int, least: float, what: str) -> None:
    """Raise unless part / whole reaches the share; an empty whole passes."""
    if whole and part / whole < least:
        raise ValueError(f"{what}: {part} of {whole} is under {least:.0%}")
