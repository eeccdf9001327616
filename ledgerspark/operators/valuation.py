"""Intrinsic values under scenarios, as column algebra."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import zero

#: Scenario parameters.
SCENARIOS = {
    "bull": {"magic": 30.0, "base_pe": 10.0, "growth_multiplier": 2.0, "aaa": 4.5, "cap": 20.0, "wacc": 0.075, "g1": 0.11, "g_end": 0.03, "oe_multiple": 19.0},
    "mid": {"magic": 22.5, "base_pe": 8.5, "growth_multiplier": 2.0, "aaa": 5.5, "cap": 15.0, "wacc": 0.09, "g1": 0.08, "g_end": 0.025, "oe_multiple": 15.0},
    "bear": {"magic": 15.0, "base_pe": 7.0, "growth_multiplier": 1.5, "aaa": 6.5, "cap": 8.0, "wacc": 0.105, "g1": 0.04, "g_end": 0.02, "oe_multiple": 11.0},
}
AAA_NORMAL = 4.4


def scenario_table(spark: SparkSession, scenarios: Mapping[str, Mapping[str, float]] = SCENARIOS, overrides: Mapping[str, Mapping[str, Mapping[str, float]]] | None = None) -> DataFrame:
    """``ticker, scenario`` and one column per parameter; ticker null: the default. Overrides are merged leaf by leaf."""
    names = sorted(next(iter(scenarios.values())))
    rows = [(None, s, *[float(p[n]) for n in names]) for s, p in scenarios.items()]
    for ticker, own in (overrides or {}).items():
        rows += [(ticker, s, *[float({**p, **own.get("all", {}), **own.get(s, {})}[n]) for n in names]) for s, p in scenarios.items()]
    return spark.createDataFrame(rows, "ticker string, scenario string, " + ", ".join(f"{n} double" for n in names))


def expand_scenarios(df: DataFrame, scenarios: Mapping[str, Mapping[str, float]] = SCENARIOS) -> DataFrame:
    """Each row once per scenario, with ``scenario`` and its parameters; a literal array, so nothing is joined."""
    names = sorted(next(iter(scenarios.values())))
    literal = F.array(*[F.struct(F.lit(s).alias("scenario"), *[F.lit(float(p[n])).alias(n) for n in names]) for s, p in scenarios.items()])
    return df.select("*", F.explode(literal).alias("__s")).select(*df.columns, "__s.*")


def graham_number(eps: Column, bvps: Column, magic: Column, retained: Column | None = None, pb: Column | None = None) -> Column:
    """Root of magic * eps * bvps for positive eps and bvps; none with retained losses or a price over 10 times book."""
    value = F.when((eps > 0) & (bvps > 0), F.sqrt(magic * eps * bvps))
    if retained is not None:
        value = F.when(F.coalesce(retained >= 0, F.lit(True)), value)
    if pb is not None:
        value = F.when(F.coalesce(pb <= 10, F.lit(True)), value)
    return value


def graham_revised(eps: Column, growth: Column, base_pe: Column, multiplier: Column, cap: Column, aaa: Column) -> Column:
    """eps * (base + multiplier * growth in percent, from 0 to the cap) * 4.4 / AAA yield; null growth gives null."""
    g = F.when(growth.isNotNull(), F.greatest(F.least(growth, cap), F.lit(0.0)))
    return F.when((eps > 0) & (aaa > 0), eps * (base_pe + multiplier * g) * AAA_NORMAL / aaa)


def two_stage_dcf(fcf: Column, g1: Column, wacc: Column, g_end: Column, years: int | Column = 10) -> Column:
    """Present value of ``years`` of cash flow grown by g1 and of its end by Gordon's formula; needs wacc > g_end."""
    n = F.lit(years) if isinstance(years, int) else years
    q = (1 + g1) / (1 + wacc)
    qn = F.pow(q, n)
    stream = F.when(F.abs(q - 1) < 1e-12, n.cast("double")).otherwise(q * (1 - qn) / (1 - q))
    return F.when((wacc > g_end) & (n >= 0), fcf * (stream + qn * (1 + g_end) / (wacc - g_end)))


def per_share(value: Column, shares: Column, net_cash: Column | None = None) -> Column:
    """A firm's value, plus its net cash (unknown: 0) where given, for one share; null without a positive count."""
    total = value if net_cash is None else value + zero(net_cash)
    return F.when(shares > 0, total / shares)


def capitalised(earnings: Column, multiple: Column | None = None, rate: Column | None = None) -> Column:
    """Owner earnings times a multiple, or divided by a positive rate; of losses none."""
    worth = earnings * multiple if multiple is not None else F.when(rate > 0, earnings / rate)
    return F.when(earnings > 0, worth)


def by_quantile(quantile: Column, low: float, mid: float, high: float, ends: tuple[float, float] = (0.10, 0.90)) -> Column:
    """A parameter that runs straight from ``low`` at the first end over ``mid`` at the median to ``high`` at the other, held beyond."""
    a, b = ends
    below = low + (mid - low) * (quantile - a) / (0.5 - a)
    above = mid + (high - mid) * (quantile - 0.5) / (b - 0.5)
    return F.when(quantile <= a, low).when(quantile >= b, high).when(quantile <= 0.5, below).otherwise(above)


def blended_growth(value: Column, start: Column, end: Column, years: int = 10, decay: float = 0.55) -> Column:
    """A value after ``years`` more years whose growth nears ``end`` exponentially."""
    grown = value
    for k in range(1, years + 1):
        grown = grown * (1 + blend(start, end, F.lit(k), decay))
    return grown


def labelled(df: DataFrame, keys: list[str], methods: Mapping[str, str], scenario: str = "scenario") -> DataFrame:
    """Long ``keys, metric, value``: one row per method and scenario, named 'method — scenario'; nulls go."""
    cells = F.array(*[F.struct(F.concat(F.lit(f"{label} — "), F.col(scenario)).alias("metric"), F.col(c).cast("double").alias("value")) for c, label in methods.items()])
    return df.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*").filter("value IS NOT NULL")


def owner_earnings(net_income: Column, da: Column, sbc: Column, capex: Column, change_wc: Column) -> Column:
    """Every unknown term counts 0."""
    return zero(net_income) + zero(da) + zero(sbc) - zero(capex) - zero(change_wc)


def margin_of_safety(value: Column, price: Column) -> Column:
    return F.when(value > 0, (value - price) / value * 100)


def present_value(amount: Column, rate: Column, years: Column) -> Column:
    return F.when(rate > -1, amount / F.pow(1 + rate, years))


def blend(start: Column, end: Column, step: Column, decay: float = 0.55) -> Column:
    """A rate that approaches ``end`` from ``start`` exponentially, ``step`` years on."""
    return end + (start - end) * F.exp(-F.lit(decay) * step)


def skip(override: Column, sector_default: Column) -> Column:
    """An explicit override beats the sector's default; neither means no skip."""
    return F.coalesce(override, sector_default, F.lit(False))
