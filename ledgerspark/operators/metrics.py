"""Ratios and scores from a wide table of statement items, one column per item.

``STATEMENT_METRICS`` maps a metric to a function of no arguments that gives its Column over the items
revenue, gross_profit, operating_income, net_income, ocf, capex, lt_debt, st_debt, equity, assets, liabilities, cash, sti,
receivables, inventory, other_current, current_assets, current_liabilities, interest, da, dividends, buybacks,
goodwill, intangibles, retained, shares. ``market_metrics`` also needs market_cap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import clamp, over_positive, percent, safe_div, sum_unless_all_null, zero

C = F.col
#: Weights of cash, short-term investments, receivables, inventory and other current assets.
HAIRCUTS = {"ncav_moderate": (1.0, 1.0, 0.75, 0.5, 0.0), "ncav_strict": (1.0, 0.9, 0.5, 0.33, 0.0)}
#: Greatest magnitudes that are kept.
CLAMPS = {"interest_coverage": 1000.0, "net_debt_to_ebitda": 100.0, "ev_to_ebitda": 500.0}


def free_cash_flow() -> Column:
    """Null unless both parts are known."""
    return C("ocf") - C("capex")


def free_cash_flow_lenient() -> Column:
    """An unknown capital expenditure counts 0, as valuation has it."""
    return C("ocf") - zero("capex")


def total_debt() -> Column:
    return sum_unless_all_null("lt_debt", "st_debt")


def ebitda() -> Column:
    return C("operating_income") + zero("da")


def net_debt() -> Column:
    return total_debt() - zero("cash") - zero("sti")


def liabilities() -> Column:
    return F.coalesce(C("liabilities"), C("assets") - C("equity"))


def tangible_book() -> Column:
    return C("equity") - zero("goodwill") - zero("intangibles")


def haircut_value(weights: tuple[float, ...]) -> Column:
    parts = ("cash", "sti", "receivables", "inventory", "other_current")
    total = F.lit(0.0)
    for w, p in zip(weights, parts, strict=True):
        total = total + zero(p) * w
    return total - liabilities()


STATEMENT_METRICS: dict[str, Callable[[], Column]] = {
    "gross_margin": lambda: percent("gross_profit", "revenue"),
    "operating_margin": lambda: percent("operating_income", "revenue"),
    "net_margin": lambda: percent("net_income", "revenue"),
    "ocf_margin": lambda: percent("ocf", "revenue"),
    "fcf_margin": lambda: percent(free_cash_flow(), "revenue"),
    "free_cash_flow": free_cash_flow,
    "total_debt": total_debt,
    "debt_to_equity": lambda: over_positive(total_debt(), "equity"),
    "debt_to_assets": lambda: safe_div(total_debt(), "assets"),
    "ebitda": ebitda,
    "net_debt": net_debt,
    "interest_coverage": lambda: clamp(safe_div("operating_income", F.abs("interest")), CLAMPS["interest_coverage"]),
    "net_debt_to_ebitda": lambda: clamp(safe_div(net_debt(), ebitda()), CLAMPS["net_debt_to_ebitda"]),
    "cash_flow_to_debt": lambda: safe_div("ocf", total_debt()),
    "current_ratio": lambda: safe_div("current_assets", "current_liabilities"),
    "quick_ratio": lambda: safe_div(C("current_assets") - zero("inventory"), "current_liabilities"),
    "invested_capital": lambda: zero("equity") + zero("lt_debt") + zero("st_debt") - zero("cash"),
    "capital_employed": lambda: C("assets") - C("current_liabilities"),
    "roa": lambda: percent("net_income", "assets"),
    "roe": lambda: percent("net_income", "equity"),
    "roic": lambda: percent("operating_income", zero("equity") + zero("lt_debt") + zero("st_debt") - zero("cash")),
    "roce": lambda: percent("operating_income", C("assets") - C("current_liabilities")),
    "croic": lambda: percent(free_cash_flow(), zero("equity") + zero("lt_debt") + zero("st_debt") - zero("cash")),
    "dividend_payout": lambda: over_positive(F.abs("dividends"), "net_income") * 100,
    "total_payout": lambda: over_positive(zero(F.abs("dividends")) + zero(F.abs("buybacks")), "net_income") * 100,
    "payout_to_fcf": lambda: over_positive(zero(F.abs("dividends")) + zero(F.abs("buybacks")), free_cash_flow()) * 100,
    "dividend_coverage": lambda: safe_div("net_income", F.abs("dividends")),
    "accruals_ratio": lambda: safe_div(C("net_income") - C("ocf"), "assets"),
    "ncav": lambda: C("current_assets") - liabilities(),
    "other_current_residual": lambda: C("current_assets") - zero("cash") - zero("sti") - zero("receivables") - zero("inventory"),
    "ncav_moderate": lambda: haircut_value(HAIRCUTS["ncav_moderate"]),
    "ncav_strict": lambda: haircut_value(HAIRCUTS["ncav_strict"]),
    "tangible_book": tangible_book,
    "goodwill_to_assets": lambda: percent(zero("goodwill"), "assets"),
    "goodwill_to_tangible": lambda: over_positive(zero("goodwill"), tangible_book()) * 100,
    "return_on_tangible": lambda: over_positive("net_income", tangible_book()) * 100,
}


def enterprise_value() -> Column:
    return C("market_cap") + zero("lt_debt") + zero("st_debt") - zero("cash") - zero("sti")


MARKET_METRICS: dict[str, Callable[[], Column]] = {
    "pe": lambda: over_positive("market_cap", "net_income"),
    "ps": lambda: safe_div("market_cap", "revenue"),
    "pb": lambda: safe_div("market_cap", "equity"),
    "p_fcf": lambda: safe_div("market_cap", free_cash_flow()),
    "p_tbv": lambda: safe_div("market_cap", tangible_book()),
    "ev_to_ebitda": lambda: clamp(safe_div(enterprise_value(), ebitda()), CLAMPS["ev_to_ebitda"]),
    "ocf_yield": lambda: percent("ocf", "market_cap"),
    "ebitda_yield": lambda: percent(ebitda(), "market_cap"),
    "dividend_yield": lambda: percent(zero(F.abs("dividends")), "market_cap"),
    "buyback_yield": lambda: percent(zero(F.abs("buybacks")), "market_cap"),
    "ncav_moderate_ratio": lambda: over_positive("market_cap", haircut_value(HAIRCUTS["ncav_moderate"])),
    "ncav_strict_ratio": lambda: over_positive("market_cap", haircut_value(HAIRCUTS["ncav_strict"])),
    "earnings_yield": lambda: F.when(C("net_income") > 0, percent("net_income", "market_cap")),
    "sales_yield": lambda: percent("revenue", "market_cap"),
    "fcf_yield": lambda: percent(free_cash_flow(), "market_cap"),
    "book_yield": lambda: percent("equity", "market_cap"),
    "shareholder_yield": lambda: percent(zero(F.abs("dividends")) + zero(F.abs("buybacks")), "market_cap"),
    "altman_z": lambda: altman_z(),
    "ncav_ratio": lambda: over_positive("market_cap", C("current_assets") - liabilities()),
}


def altman_z() -> Column:
    """Null if any term is, or unless assets and liabilities are positive."""
    a, owed = C("assets"), liabilities()
    z = 1.2 * (C("current_assets") - C("current_liabilities")) / a + 1.4 * C("retained") / a + 3.3 * C("operating_income") / a + 0.6 * C("market_cap") / owed + C("revenue") / a
    return F.when((a > 0) & (owed > 0), z)


def altman_zone(z: Column) -> Column:
    return F.when(z > 3.0, "safe").when(z < 1.8, "distress").when(z.isNotNull(), "grey")


PER_SHARE: dict[str, Callable[[], Column]] = {
    "ncav_per_share": lambda: over_positive(C("current_assets") - liabilities(), "shares"),
    "ncav_moderate_per_share": lambda: over_positive(haircut_value(HAIRCUTS["ncav_moderate"]), "shares"),
    "ncav_strict_per_share": lambda: over_positive(haircut_value(HAIRCUTS["ncav_strict"]), "shares"),
    "tangible_book_per_share": lambda: over_positive(tangible_book(), "shares"),
}


def fresh(value: Column, as_of: Column, today: Column, days: int = 400) -> Column:
    """A value that is not older than so many days."""
    return F.when(F.datediff(today, as_of).between(0, days), value)


def live_multiples(price: Column, shares: Column) -> dict[str, Column]:
    """Multiples of trailing sums (ttm_net_income, ttm_ebitda), latest equity, NCAV and debt at a live price."""
    cap = price * shares
    return {
        "live_pe": over_positive(cap, "ttm_net_income"), "live_pb": over_positive(cap, "equity"), "live_ncav_per_share": over_positive(C("ncav"), shares),
        "live_ncav_ratio": over_positive(cap, "ncav"), "live_ev_to_ebitda": over_positive(cap + zero("debt") - zero("cash"), "ttm_ebitda"),
    }


def add_metrics(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the named metrics, in one projection."""
    every = {**STATEMENT_METRICS, **MARKET_METRICS, **PER_SHARE}
    return df.select("*", *[every[n]().alias(n) for n in names])
