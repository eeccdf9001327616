"""Checks that report and never repair: splits, reconciliation against presented lines, backtest bias, coverage and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.asof import factor_after
from ledgerspark.operators.dedup import top_n

#: Days and share by which a known split may be off.
SPLIT_DAYS, SPLIT_SHARE = 3, 0.01


def malformed_splits(splits: DataFrame) -> DataFrame:
    """Splits (ticker, split_date, ratio) without a key or a positive ratio."""
    return splits.filter("ticker IS NULL OR split_date IS NULL OR ratio IS NULL OR ratio <= 0")


def known_splits(known: DataFrame, splits: DataFrame) -> DataFrame:
    """``known`` (ticker, ex_date, ratio) with ``found``: whether one of about that date and ratio is recorded."""
    own = splits.select(F.col("ticker").alias("__t"), "split_date", F.col("ratio").alias("__r"))
    near = (F.col("ticker") == F.col("__t")) & (F.abs(F.datediff("split_date", "ex_date")) <= SPLIT_DAYS) & (F.abs(F.col("__r") - F.col("ratio")) / F.col("ratio") <= SPLIT_SHARE)
    return known.join(own, near, "left_semi").withColumn("found", F.lit(True)).unionByName(known.join(own, near, "left_anti").withColumn("found", F.lit(False)))


def rescaled_latest(periods: DataFrame, splits: DataFrame) -> DataFrame:
    """Latest periods (of ticker, fiscal_year, period_end) that a later split would rescale: their factor is not 1."""
    latest = periods.groupBy("ticker").agg(F.max_by("period_end", "fiscal_year").alias("period_end"), F.max("fiscal_year").alias("fiscal_year"))
    return factor_after(latest, splits, ["ticker"], ["ticker"], "period_end", "split_date", "ratio").filter(F.abs(F.col("factor") - 1) > 1e-9)


def presented_against_kept(lines: DataFrame, lookup: DataFrame, kept: DataFrame, expected: DataFrame, tolerance: float = 0.005, skipped: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``ticker, stmt, concept, period_end, issue, kept_value, presented``: three kinds of findings about presented yearly lines.

    COVERAGE_GAP: a presented line (ticker, stmt, tag, period_end, value, negated) whose concept, or tag without one, is not kept.
    VALUE_MISMATCH: the kept value differs from the line whose tag has the best priority (then the greatest magnitude),
    unless a negated line explains the sign; ``skipped`` (concept, statement) are left out. PARSE_FAIL: an expected (ticker, stmt)
    without any line.
    """
    known = lookup.select("tag", "stmt", F.col("concept").alias("__c"), "priority")
    mapped = lines.join(known, ["tag", "stmt"], "left").withColumn("concept", F.coalesce("__c", "tag"))
    keys = ["ticker", "stmt", "concept", "period_end"]
    have = kept.filter("value IS NOT NULL").select(*keys, F.col("value").alias("kept_value"))
    shape = lambda df, issue, own, seen: df.select("ticker", "stmt", "concept", "period_end", F.lit(issue).alias("issue"), own.cast("double").alias("kept_value"), seen.cast("double").alias("presented"))
    gap = mapped.join(have, keys, "left_anti").groupBy(*keys).agg(F.max_by("value", F.struct(F.abs("value"), "value")).alias("value"))
    best = top_n(mapped.filter("__c IS NOT NULL"), keys, [F.asc("priority"), F.abs("value").desc(), F.desc("value"), F.asc("tag")])
    off = F.abs((F.col("kept_value") - F.col("value")) / F.when(F.col("value") != 0, F.col("value"))) > tolerance
    flipped = F.col("negated") & (F.abs((F.col("kept_value") + F.col("value")) / F.when(F.col("value") != 0, F.col("value"))) <= tolerance)
    wrong = best.join(have, keys).filter(off & ~F.coalesce(flipped, F.lit(False)))
    for concept, statement in skipped:
        wrong = wrong.filter(~((F.col("concept") == concept) & (F.col("stmt") == statement)))
    none = F.lit(None)
    silent = expected.select("ticker", "stmt").distinct().join(lines, ["ticker", "stmt"], "left_anti")
    silent = silent.withColumn("concept", none.cast("string")).withColumn("period_end", none.cast(lines.schema["period_end"].dataType))
    return shape(gap, "COVERAGE_GAP", none, F.col("value")).unionByName(shape(wrong, "VALUE_MISMATCH", F.col("kept_value"), F.col("value"))).unionByName(shape(silent, "PARSE_FAIL", none, none))


def bias_report(rows: DataFrame, group: str) -> DataFrame:
    """Per group of priced rows (as_of, entry_date, exit_date, holding_return, benchmark_return): look-ahead and order errors, coverage."""
    held = F.col("holding_return").isNotNull()
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("entry_date") > F.col("as_of")).alias("look_ahead"),
        F.count_if(F.col("exit_date") <= F.col("entry_date")).alias("exit_before_entry"), F.count("exit_date").alias("with_exit"),
        (F.count_if(held & F.col("benchmark_return").isNull()) / F.when(F.count_if(held) > 0, F.count_if(held))).alias("benchmark_missing"),
    )


def out_of_bounds(summary: DataFrame, cagr: float = 1.0, sharpe: float = 5.0, drawdown: float = -0.95) -> DataFrame:
    """Summaries (cagr, sharpe, max_drawdown) that are not plausible."""
    return summary.filter((F.abs("cagr") > cagr) | (F.abs("sharpe") > sharpe) | (F.col("max_drawdown") < drawdown))


def funnel(df: DataFrame, status: str, reason: str) -> DataFrame:
    """How many rows end in each status, by reason."""
    return df.groupBy(status, reason).agg(F.count(F.lit(1)).alias("n"))


def year_bound(df: DataFrame, year: str, current: Column) -> DataFrame:
    """One row: the newest year, and FAIL if it lies after ``current``, SKIP without rows, else PASS."""
    newest = F.max(year)
    return df.agg(newest.alias("newest"), F.when(newest.isNull(), "SKIP").when(newest > current, "FAIL").otherwise("PASS").alias("verdict"))


def synonym_coverage(df: DataFrame, key: str, name: str, year: str, own: str, synonyms: Sequence[str]) -> DataFrame:
    """Per key: years that ``own`` has, years that it or any synonym has, and the sorted years that only synonyms give."""
    known = df.filter(F.col(name).isin(own, *synonyms))
    sets = known.groupBy(key).agg(F.collect_set(F.when(F.col(name) == own, F.col(year))).alias("__own"), F.collect_set(year).alias("__all"))
    return sets.select(key, F.size("__own").cast("long").alias("own_years"), F.size("__all").cast("long").alias("all_years"), F.array_sort(F.array_except("__all", "__own")).alias("gained"))


def worst(df: DataFrame, difference: Column, then: Sequence[Column], n: int = 20) -> DataFrame:
    """The ``n`` rows with the greatest absolute difference."""
    return df.orderBy(F.abs(difference).desc_nulls_last(), *then).limit(n)


def coverage(scope: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys present, those of them that ``scope`` covers, their share, and whether the scope contains them all."""
    flagged = present.select(key).distinct().join(scope.select(key, F.lit(True).alias("__in")).distinct(), key, "left")
    n, had = F.count(F.lit(1)), F.count("__in")
    return flagged.agg(n.alias("present"), had.alias("covered"), F.when(n > 0, had / n).alias("share"), (had == n).alias("contained"))


def run_trend(runs: DataFrame, run: str, started: str, minutes: str, status: str, last: int) -> DataFrame:
    """The ``last`` runs by start: total minutes, steps, failed and skipped ones."""
    g = runs.groupBy(run).agg(F.min(started).alias(started), F.sum(minutes).alias("total_minutes"), F.count(F.lit(1)).alias("n_steps"), F.count_if(F.col(status) == "failed").alias("n_failed"), F.count_if(F.col(status) == "skipped").alias("n_skipped"))
    return g.orderBy(F.desc(started), F.desc(run)).limit(last)
