"""Screens, bands, peers and ratio panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators import metrics, reshape, screener, windows
from ledgerspark.operators.dedup import latest
from ledgerspark.operators.forecast import decile
from ledgerspark.queries.registry import METRICS, STATEMENTS, YEARLY, Tables, query, r

_BANDS = (("negative", None, 0.0), ("low", 0.0, 2500.0), ("mid", 2500.0, 7500.0), ("high", 7500.0, None))


@query("""SELECT c_custkey FROM customer WHERE c_acctbal >= 1000 AND c_acctbal <= 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND upper(c_name) LIKE '%99%'""")
def range_and_scope(t: Tables) -> DataFrame:
    found = screener.scope(t.customer, {"c_mktsegment": ["BUILDING", "MACHINERY"]}, ("99", ["c_name"]))
    return found.filter(screener.in_range("c_acctbal", 1000, 5000)).select("c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN 'low' WHEN c_acctbal < 7500 THEN 'mid' ELSE 'high' END AS band, CASE WHEN c_acctbal >= 5000 THEN 'green' WHEN c_acctbal <= 500 THEN 'red' ELSE 'yellow' END AS light FROM customer""")
def bands_and_lights(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", screener.band("c_acctbal", _BANDS).alias("band"), screener.traffic_light(F.col("c_acctbal"), 5000, 500).alias("light"))


@query("""SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN 'low' WHEN c_acctbal < 7500 THEN 'mid' ELSE 'high' END AS band, CAST(count(*) AS BIGINT) AS n, round(median(c_acctbal), 6) AS median_balance FROM customer GROUP BY 1""")
def band_counts(t: Tables) -> DataFrame:
    return t.customer.groupBy(screener.band("c_acctbal", _BANDS).alias("band")).agg(F.count(F.lit(1)).alias("n"), r(F.median("c_acctbal"), 6).alias("median_balance"))


@query("""WITH s AS (SELECT *, c_mktsegment || '/' || c_nationkey AS industry, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS x FROM customer),
i AS (SELECT industry, median(x) AS m, count(x) AS n FROM s GROUP BY 1), g AS (SELECT c_mktsegment, median(x) AS m, count(x) AS n FROM s GROUP BY 1)
SELECT c_custkey, CASE WHEN i.n >= 12 THEN 'industry' WHEN g.n >= 12 THEN 'sector' END AS basis, round(CASE WHEN i.n >= 12 THEN i.m WHEN g.n >= 12 THEN g.m END, 6) AS peer_median, CASE WHEN i.n >= 12 THEN i.n WHEN g.n >= 12 THEN g.n END AS peers FROM s JOIN i USING (industry) JOIN g USING (c_mktsegment)""")
def peer_median(t: Tables) -> DataFrame:
    s = t.customer.select("c_custkey", F.col("c_mktsegment").alias("sector"), F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("industry"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("x"))
    return screener.peer_medians(s, "c_custkey", ["industry", "sector"], "x", 12).select("c_custkey", "basis", r("peer_median", 6).alias("peer_median"), "peers")


@query("""WITH g AS (SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS nation, count(*) AS n FROM customer GROUP BY 1, 2), m AS (SELECT c_mktsegment, min(nation) AS mode FROM g WHERE n = (SELECT max(n) FROM g h WHERE h.c_mktsegment = g.c_mktsegment) GROUP BY 1)
SELECT c_mktsegment, mode, CAST(count(*) AS BIGINT) AS n, round(median(c_acctbal), 6) AS median_balance FROM customer JOIN m USING (c_mktsegment) GROUP BY 1, 2 HAVING count(*) >= 3""")
def industry_summary(t: Tables) -> DataFrame:
    c = t.customer.withColumn("nation", F.col("c_nationkey").cast("long"))
    stats = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), r(F.median("c_acctbal"), 6).alias("median_balance")).filter("n >= 3")
    return stats.join(screener.mode(c, ["c_mktsegment"], "nation"), "c_mktsegment").select("c_mktsegment", "mode", "n", "median_balance")


@query("""SELECT o_orderstatus AS concept, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n, round(count(DISTINCT o_custkey) / (SELECT CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM orders), 6) AS fill_rate FROM orders WHERE o_orderkey % 5 = 0 OR o_orderstatus = 'F' GROUP BY 1""")
def fill_rate(t: Tables) -> DataFrame:
    total = t.orders.agg(F.count_distinct("o_custkey").alias("of"))
    n = t.orders.filter("o_orderkey % 5 = 0 OR o_orderstatus = 'F'").groupBy(F.col("o_orderstatus").alias("concept")).agg(F.count_distinct("o_custkey").alias("n"))
    return n.crossJoin(F.broadcast(total)).select("concept", "n", r(F.col("n") / F.col("of"), 6).alias("fill_rate"))


@query("""WITH e AS (SELECT year(o_orderdate) AS y, quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM orders GROUP BY 1)
SELECT o_orderkey, CAST(1 + len(list_filter(q, lambda x: x < o_totalprice)) AS BIGINT) AS decile FROM orders JOIN e ON year(o_orderdate) = y""")
def decile_by_year(t: Tables) -> DataFrame:
    return decile(t.orders.withColumn("y", F.year("o_orderdate")), ["y"], "o_totalprice").select("o_orderkey", "decile")


_RATIOS = ["gross_margin", "operating_margin", "net_margin", "ocf_margin", "fcf_margin", "free_cash_flow", "total_debt", "debt_to_equity", "debt_to_assets", "ebitda", "net_debt", "interest_coverage", "net_debt_to_ebitda", "cash_flow_to_debt"]


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END"


def _pos(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) END"


def _z(x: str) -> str:
    return f"coalesce({x}, 0)"


_DEBT = "CASE WHEN lt_debt IS NOT NULL OR st_debt IS NOT NULL THEN coalesce(lt_debt, 0) + coalesce(st_debt, 0) END"
_EBITDA = "operating_income + coalesce(da, 0)"
_NET = f"({_DEBT}) - coalesce(cash, 0) - coalesce(sti, 0)"
_OWED = "coalesce(liabilities, assets - equity)"
_TBV = "equity - coalesce(goodwill, 0) - coalesce(intangibles, 0)"
_CAPITAL = "coalesce(equity, 0) + coalesce(lt_debt, 0) + coalesce(st_debt, 0) - coalesce(cash, 0)"
_PAID = "coalesce(abs(dividends), 0) + coalesce(abs(buybacks), 0)"
_SQL = {
    "gross_margin": _div("gross_profit", "revenue") + " * 100", "operating_margin": _div("operating_income", "revenue") + " * 100", "net_margin": _div("net_income", "revenue") + " * 100", "ocf_margin": _div("ocf", "revenue") + " * 100",
    "fcf_margin": _div("ocf - capex", "revenue") + " * 100", "free_cash_flow": "ocf - capex", "total_debt": _DEBT, "debt_to_equity": _pos(_DEBT, "equity"), "debt_to_assets": _div(_DEBT, "assets"), "ebitda": _EBITDA, "net_debt": _NET,
    "interest_coverage": f"CASE WHEN abs({_div('operating_income', 'abs(interest)')}) <= 1000 THEN {_div('operating_income', 'abs(interest)')} END", "net_debt_to_ebitda": f"CASE WHEN abs({_div(_NET, _EBITDA)}) <= 100 THEN {_div(_NET, _EBITDA)} END", "cash_flow_to_debt": _div("ocf", _DEBT),
    "current_ratio": _div("current_assets", "current_liabilities"), "quick_ratio": _div("current_assets - coalesce(inventory, 0)", "current_liabilities"), "invested_capital": _CAPITAL, "capital_employed": "assets - current_liabilities",
    "roa": _div("net_income", "assets") + " * 100", "roe": _div("net_income", "equity") + " * 100", "roic": _div("operating_income", _CAPITAL) + " * 100", "roce": _div("operating_income", "assets - current_liabilities") + " * 100", "croic": _div("ocf - capex", _CAPITAL) + " * 100",
    "dividend_payout": _pos("abs(dividends)", "net_income") + " * 100", "total_payout": _pos(_PAID, "net_income") + " * 100", "payout_to_fcf": _pos(_PAID, "ocf - capex") + " * 100", "dividend_coverage": _div("net_income", "abs(dividends)"), "accruals_ratio": _div("net_income - ocf", "assets"),
    "ncav": f"current_assets - {_OWED}", "other_current_residual": "current_assets - coalesce(cash, 0) - coalesce(sti, 0) - coalesce(receivables, 0) - coalesce(inventory, 0)",
    "ncav_moderate": f"coalesce(cash, 0) + coalesce(sti, 0) + 0.75 * coalesce(receivables, 0) + 0.5 * coalesce(inventory, 0) - {_OWED}", "ncav_strict": f"coalesce(cash, 0) + 0.9 * coalesce(sti, 0) + 0.5 * coalesce(receivables, 0) + 0.33 * coalesce(inventory, 0) - {_OWED}",
    "tangible_book": _TBV, "goodwill_to_assets": _div(_z("goodwill"), "assets") + " * 100", "goodwill_to_tangible": _pos(_z("goodwill"), _TBV) + " * 100", "return_on_tangible": _pos("net_income", _TBV) + " * 100",
    "pe": _pos("market_cap", "net_income"), "ps": _div("market_cap", "revenue"), "pb": _div("market_cap", "equity"), "p_fcf": _div("market_cap", "ocf - capex"), "p_tbv": _div("market_cap", _TBV),
    "earnings_yield": f"CASE WHEN net_income > 0 THEN {_div('net_income', 'market_cap')} * 100 END", "sales_yield": _div("revenue", "market_cap") + " * 100", "fcf_yield": _div("ocf - capex", "market_cap") + " * 100", "book_yield": _div("equity", "market_cap") + " * 100", "shareholder_yield": _div(_PAID, "market_cap") + " * 100",
    "altman_z": f"CASE WHEN assets > 0 AND {_OWED} > 0 THEN 1.2 * (current_assets - current_liabilities) / assets + 1.4 * retained / assets + 3.3 * operating_income / assets + 0.6 * market_cap / {_OWED} + revenue / assets END", "ncav_ratio": _pos("market_cap", f"current_assets - {_OWED}"),
}
_EV = "market_cap + coalesce(lt_debt, 0) + coalesce(st_debt, 0) - coalesce(cash, 0) - coalesce(sti, 0)"
_SQL["ev_to_ebitda"] = f"CASE WHEN abs({_div(_EV, _EBITDA)}) <= 500 THEN {_div(_EV, _EBITDA)} END"


def _panel_sql(names: list[str]) -> str:
    return f"WITH {STATEMENTS} SELECT ticker, fiscal_year, " + ", ".join(f"round({_SQL[n]}, 4) AS {n}" for n in names) + " FROM statements"


def _panel(t: Tables, names: list[str]) -> DataFrame:
    return metrics.add_metrics(t.statements(), names).select("ticker", "fiscal_year", *[r(n).alias(n) for n in names])


_RETURNS = ["current_ratio", "quick_ratio", "invested_capital", "capital_employed", "roa", "roe", "roic", "roce", "croic", "dividend_payout", "total_payout", "payout_to_fcf", "dividend_coverage", "accruals_ratio"]
_ASSETS = ["ncav", "other_current_residual", "ncav_moderate", "ncav_strict", "tangible_book", "goodwill_to_assets", "goodwill_to_tangible", "return_on_tangible"]
_MARKET = ["pe", "ps", "pb", "p_fcf", "p_tbv", "ev_to_ebitda", "earnings_yield", "sales_yield", "fcf_yield", "book_yield", "shareholder_yield", "ncav_ratio"]


@query(_panel_sql(_RATIOS))
def ratio_panel(t: Tables) -> DataFrame:
    return _panel(t, _RATIOS)


@query(_panel_sql(_RETURNS))
def returns_panel(t: Tables) -> DataFrame:
    return _panel(t, _RETURNS)


@query(_panel_sql(_ASSETS))
def asset_value_panel(t: Tables) -> DataFrame:
    return _panel(t, _ASSETS)


@query(_panel_sql(_MARKET))
def market_panel(t: Tables) -> DataFrame:
    return _panel(t, _MARKET)


@query(f"""WITH {STATEMENTS} SELECT ticker, fiscal_year, round(z, 4) AS altman_z, CASE WHEN z > 3.0 THEN 'safe' WHEN z < 1.8 THEN 'distress' WHEN z IS NOT NULL THEN 'grey' END AS zone FROM (SELECT *, {_SQL['altman_z']} AS z FROM (SELECT ticker, fiscal_year, revenue, coalesce(assets, 1) AS assets, coalesce(equity, 0) AS equity, liabilities, coalesce(current_assets, 0) AS current_assets, coalesce(current_liabilities, 0) AS current_liabilities, coalesce(retained, 0) AS retained, coalesce(operating_income, 0) AS operating_income, market_cap FROM statements))""")
def altman(t: Tables) -> DataFrame:
    s = t.statements().withColumn("assets", F.coalesce("assets", F.lit(1.0)))
    for c in ("equity", "current_assets", "current_liabilities", "retained", "operating_income"):
        s = s.withColumn(c, F.coalesce(c, F.lit(0.0)))
    z = s.withColumn("z", metrics.altman_z())
    return z.select("ticker", "fiscal_year", r("z").alias("altman_z"), metrics.altman_zone(F.col("z")).alias("zone"))


@query(f"""WITH {STATEMENTS}, m AS (SELECT ticker, fiscal_year, {_SQL['ncav']} AS ncav, {_SQL['ncav_moderate']} AS moderate, {_SQL['ncav_strict']} AS strict, market_cap FROM statements)
SELECT ticker, fiscal_year, round(market_cap / ncav, 4) AS ratio, coalesce(strict <= moderate + 1e-6, false) AS ordered FROM m WHERE ncav > 0 AND market_cap / ncav <= 4""")
def net_net_screen(t: Tables) -> DataFrame:
    m = metrics.add_metrics(t.statements(), ["ncav", "ncav_moderate", "ncav_strict", "ncav_ratio"])
    ordered = F.coalesce(F.col("ncav_strict") <= F.col("ncav_moderate") + 1e-6, F.lit(False))
    return m.filter(screener.in_range("ncav_ratio", high=4)).select("ticker", "fiscal_year", r("ncav_ratio").alias("ratio"), ordered.alias("ordered"))


@query(f"""WITH {STATEMENTS}, {YEARLY}, p AS (SELECT ticker, fiscal_year, {_SQL['pe']} AS pe, {_SQL['pb']} AS pb, {_SQL['current_ratio']} AS cr, max(fiscal_year) OVER (PARTITION BY ticker) AS anchor FROM statements),
s AS (SELECT ticker FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM yearly) WHERE rn <= 5 GROUP BY 1 HAVING count(*) = 5 AND count(*) FILTER (revenue > 0) = 5)
SELECT p.ticker, round(pe, 4) AS pe, round(pb, 4) AS pb FROM p JOIN s USING (ticker) WHERE fiscal_year = anchor AND coalesce(pe <= 100, false) AND (coalesce(pb <= 2, false) OR coalesce(pe * pb <= 200, false)) AND coalesce(cr >= 0.1, true)""")
def preset_defensive(t: Tables) -> DataFrame:
    p = metrics.add_metrics(t.statements(), ["pe", "pb", "current_ratio"])
    p = p.withColumn("anchor", F.max("fiscal_year").over(Window.partitionBy("ticker"))).filter("fiscal_year = anchor")
    steady = windows.sustained(t.yearly(), ["ticker"], "fiscal_year", F.col("revenue") > 0, 5)
    cheap = screener.in_range("pb", high=2) | F.coalesce(F.col("pe") * F.col("pb") <= 200, F.lit(False))
    liquid = F.coalesce(F.col("current_ratio") >= 0.1, F.lit(True))
    return p.join(steady, "ticker", "left_semi").filter(screener.in_range("pe", high=100) & cheap & liquid).select("ticker", r("pe").alias("pe"), r("pb").alias("pb"))


@query(f"""WITH {METRICS}, w AS (SELECT ticker, max_by(value, fiscal_year) FILTER (metric = 'revenue') AS revenue, max_by(value, fiscal_year) FILTER (metric = 'average') AS average FROM metrics GROUP BY 1)
SELECT ticker, revenue, round(average, 4) AS average FROM w WHERE revenue >= 200000 AND average <= 200000 ORDER BY revenue DESC NULLS LAST, ticker LIMIT 50 OFFSET 10""")
def metric_page(t: Tables) -> DataFrame:
    wide = reshape.latest_each(t.metrics(), ["ticker"], "metric", "fiscal_year", "value", ["revenue", "average"])
    found = wide.filter(screener.in_range("revenue", low=200000) & screener.in_range("average", high=200000))
    return found.orderBy(F.desc_nulls_last("revenue"), "ticker").offset(10).limit(50).select("ticker", "revenue", r("average").alias("average"))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, round(CASE WHEN max(revenue) OVER w > min(revenue) OVER w THEN (revenue - min(revenue) OVER w) / (max(revenue) OVER w - min(revenue) OVER w) END, 6) AS position FROM yearly WINDOW w AS (PARTITION BY ticker)""")
def range_position(t: Tables) -> DataFrame:
    return t.yearly().select("ticker", "fiscal_year", r(screener.range_position("revenue", ["ticker"]), 6).alias("position"))


@query("""SELECT DISTINCT c_mktsegment AS choice FROM customer WHERE c_mktsegment IS NOT NULL""")
def pickers(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_mktsegment").alias("choice")).filter("choice IS NOT NULL").distinct()


@query(f"""WITH {METRICS} SELECT ticker, metric, fiscal_year, round(value, 4) AS value FROM metrics QUALIFY row_number() OVER (PARTITION BY ticker, metric ORDER BY fiscal_year DESC) = 1""")
def latest_metrics(t: Tables) -> DataFrame:
    return latest(t.metrics(), ["ticker", "metric"], ["fiscal_year"]).select("ticker", "metric", "fiscal_year", r("value").alias("value"))
