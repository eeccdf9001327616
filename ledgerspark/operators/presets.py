"""Preset screens at three levels, and the screen of companies priced under their liquidation value.

A preset looks at a company's latest figures (``latest_rule``) and at its years (``multi_year``). Unknown figures fail, but for
the margin of safety, which some sectors do not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.windows import sustained

LEVELS = ("relaxed", "moderate", "strict")

#: Thresholds of each preset and level.
THRESHOLDS = {
    "graham": {
        "strict": {"cr_min": 2.0, "pe_max": 15.0, "pb_max": 1.5, "pe_pb_max": 22.5, "earnings_years": 10, "div_years": 10, "div_min_years": 10, "eps_years": 10, "eps_min_growth": 1.33, "eps_use_3y_avg": True},
        "moderate": {"cr_min": 1.75, "pe_max": 17.5, "pb_max": 2.0, "pe_pb_max": 26.0, "earnings_years": 7, "div_years": 7, "div_min_years": 5, "eps_years": 7, "eps_min_growth": 1.33, "eps_use_3y_avg": False},
        "relaxed": {"cr_min": 1.5, "pe_max": 20.0, "pb_max": 2.5, "pe_pb_max": 30.0, "earnings_years": 5, "div_years": 5, "div_min_years": 3, "eps_years": 5, "eps_min_growth": 1.33, "eps_use_3y_avg": False},
    },
    "buffett": {
        "strict": {"de_max": 0.35, "gm_min": 50.0, "nm_min": 25.0, "mos_min": 33.0, "roe_min": 15.0, "roe_years": 10},
        "moderate": {"de_max": 0.5, "gm_min": 40.0, "nm_min": 20.0, "mos_min": 25.0, "roe_min": 15.0, "roe_years": 5},
        "relaxed": {"de_max": 0.75, "gm_min": 30.0, "nm_min": 12.0, "mos_min": 15.0, "roe_min": 12.0, "roe_years": 3},
    },
    "lynch": {
        "strict": {"de_max": 0.4, "cr_min": 1.5, "roe_min": 20.0, "peg_max": 0.75},
        "moderate": {"de_max": 0.6, "cr_min": 1.0, "roe_min": 15.0, "peg_max": 1.0},
        "relaxed": {"de_max": 1.0, "cr_min": 0.8, "roe_min": 10.0, "peg_max": 1.5},
    },
}


def thresholds(preset: str, level: str) -> dict:
    """Those of a preset; an unknown level counts as strict, an unknown preset raises."""
    return THRESHOLDS[preset].get(level, THRESHOLDS[preset]["strict"])


def latest_rule(preset: str, level: str) -> Column:
    """Whether a company's latest figures pass. Reads current_ratio, pe, pb, debt_equity, gross_margin, net_margin, mos, roe, peg as the preset needs them."""
    t, c = thresholds(preset, level), F.col
    if preset == "graham":
        rule = (c("current_ratio") >= t["cr_min"]) & (c("pe") <= t["pe_max"]) & ((c("pb") <= t["pb_max"]) | (c("pe") * c("pb") <= t["pe_pb_max"]))
    elif preset == "buffett":
        rule = (c("debt_equity") <= t["de_max"]) & (c("gross_margin") > t["gm_min"]) & (c("net_margin") > t["nm_min"]) & (c("mos").isNull() | (c("mos") >= t["mos_min"]))
    else:
        rule = (c("debt_equity") < t["de_max"]) & (c("current_ratio") >= t["cr_min"]) & (c("roe") > t["roe_min"]) & (c("peg") < t["peg_max"])
    return F.coalesce(rule, F.lit(False))


def lasting(df: DataFrame, key: str, year: str, value: str, least: float, years: int) -> DataFrame:
    """Keys whose last ``years`` known values all reach ``least``; fewer known values do not pass."""
    return sustained(df.filter(F.col(value).isNotNull()), [key], year, F.col(value) >= least, years)


def unbroken(df: DataFrame, key: str, year: str, value: str, least: float, years: int, least_years: int, grace: int = 1) -> DataFrame:
    """Keys whose latest run of consecutive years that reach ``least`` has ``least_years`` of the last ``years`` such years, and ends at most ``grace`` years before the key's latest row of all."""
    paid = F.col(value) >= least
    newest = df.groupBy(key).agg(F.max(year).alias("__newest"))
    ranked = df.filter(paid).withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(year)))).filter(F.col("__rn") <= years)
    runs = ranked.groupBy(key, (F.col(year) + F.col("__rn")).alias("__run")).agg(F.count(F.lit(1)).alias("__n"), F.max(year).alias("__last"))
    last = runs.groupBy(key).agg(F.max_by(F.struct("__n", "__last"), "__last").alias("__r"))
    return last.join(newest, key).filter((F.col("__r.__n") >= least_years) & (F.col("__r.__last") >= F.col("__newest") - grace)).select(key)


def grown(df: DataFrame, key: str, year: str, value: str, years: int, growth: float, averaged: bool) -> DataFrame:
    """Keys whose latest known value is ``growth`` times the one exactly ``years`` before, both over 0; or, averaged, the means of the three years at each end of the span."""
    known = df.filter(F.col(value).isNotNull()).withColumn("__newest", F.max(year).over(Window.partitionBy(key)))
    late, early = (F.col("__newest") - 2, F.col("__newest")), (F.col("__newest") - (years - 1), F.col("__newest") - (years - 3))
    if not averaged:
        late, early = (F.col("__newest"),) * 2, (F.col("__newest") - years,) * 2
    at = lambda span: F.when(F.col(year).between(*span), F.col(value))
    ends = known.groupBy(key).agg(F.avg(at(late)).alias("__l"), F.count(at(late)).alias("__nl"), F.avg(at(early)).alias("__e"), F.count(at(early)).alias("__ne"))
    n = 3 if averaged else 1
    return ends.filter((F.col("__nl") == n) & (F.col("__ne") == n) & (F.col("__l") > 0) & (F.col("__e") > 0) & (F.col("__l") >= F.col("__e") * growth)).select(key)


def multi_year(annual: DataFrame, preset: str, level: str, key: str = "ticker", year: str = "fiscal_year") -> DataFrame | None:
    """Keys that pass the preset's checks over years (one row per key and year with roe, or net_income, dividend_yield, eps); None where it has none."""
    t = thresholds(preset, level)
    if preset == "buffett":
        return lasting(annual, key, year, "roe", t["roe_min"], t["roe_years"])
    if preset != "graham":
        return None
    earned = lasting(annual, key, year, "net_income", 0.0, t["earnings_years"])
    paid = unbroken(annual, key, year, "dividend_yield", 0.0, t["div_years"], t["div_min_years"])
    risen = grown(annual, key, year, "eps", t["eps_years"], t["eps_min_growth"], t["eps_use_3y_avg"])
    return earned.join(paid, key, "left_semi").join(risen, key, "left_semi")


def preset_screen(latest: DataFrame, annual: DataFrame, preset: str, level: str, key: str = "ticker") -> DataFrame:
    """Rows of ``latest`` (one per key) that pass both."""
    found, lasting_keys = latest.filter(latest_rule(preset, level)), multi_year(annual, preset, level, key)
    return found if lasting_keys is None else found.join(lasting_keys, key, "left_semi")


def net_nets(df: DataFrame, ratio: str, f_score: str, hide_traps: bool = False, min_discount: float | None = None, floor: float = 4.0) -> DataFrame:
    """Candidates by price to liquidation value. Traps are scores under ``floor`` (an unknown score stays); with a least discount in
    percent, only strictly greater ones stay and an unknown ratio goes."""
    if hide_traps:
        df = df.filter(F.col(f_score).isNull() | (F.col(f_score) >= floor))
    return df if min_discount is None else df.filter(F.col(ratio) < 1 - min_discount / 100)


def net_net_stats(df: DataFrame, ratio: str, classic: float = 0.67) -> DataFrame:
    """One row about the screen's own rows: how many, under their value, and under the classic share of it."""
    return df.agg(F.count(F.lit(1)).alias("eligible"), F.count_if(F.col(ratio) < 1).alias("below_value"), F.count_if(F.col(ratio) <= classic).alias("classic"))
