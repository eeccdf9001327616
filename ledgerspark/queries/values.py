"""Valuation, backtests and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import backtest, forecast, valuation
from ledgerspark.queries.registry import BRAND_YEARS, STATEMENTS, YEARLY, Tables, query, r

_SCENARIOS = "scen(scenario, magic, base_pe, growth_multiplier, aaa, cap, wacc, g1, g_end, oe_multiple) AS (VALUES ('bull', 30.0::DOUBLE, 10.0::DOUBLE, 2.0::DOUBLE, 4.5::DOUBLE, 20.0::DOUBLE, 0.075::DOUBLE, 0.11::DOUBLE, 0.03::DOUBLE, 19.0::DOUBLE), ('mid', 22.5, 8.5, 2.0, 5.5, 15.0, 0.09, 0.08, 0.025, 15.0), ('bear', 15.0, 7.0, 1.5, 6.5, 8.0, 0.105, 0.04, 0.02, 11.0))"


@query(f"""WITH {YEARLY}, {_SCENARIOS}, x AS (SELECT ticker, fiscal_year, scenario, revenue / 1000 - 50 AS eps, revenue / 500 AS bvps, n_orders * 7.5::DOUBLE AS growth, scen.* EXCLUDE (scenario) FROM yearly CROSS JOIN scen)
SELECT ticker, fiscal_year, scenario, round(CASE WHEN eps > 0 AND bvps > 0 THEN sqrt(magic * eps * bvps) END, 4) AS graham_number, round(CASE WHEN eps > 0 THEN eps * (base_pe + growth_multiplier * greatest(least(growth, cap), 0)) * 4.4::DOUBLE / aaa END, 4) AS graham_revised FROM x""")
def graham(t: Tables) -> DataFrame:
    x = valuation.expand_scenarios(t.yearly().select("ticker", "fiscal_year", (F.col("revenue") / 1000 - 50).alias("eps"), (F.col("revenue") / 500).alias("bvps"), (F.col("n_orders") * 7.5).alias("growth")))
    c = F.col
    return x.select("ticker", "fiscal_year", "scenario", r(valuation.graham_number(c("eps"), c("bvps"), c("magic"))).alias("graham_number"), r(valuation.graham_revised(c("eps"), c("growth"), c("base_pe"), c("growth_multiplier"), c("cap"), c("aaa"))).alias("graham_revised"))


@query(f"""WITH {YEARLY}, {_SCENARIOS}, x AS (SELECT ticker, fiscal_year, scenario, revenue AS fcf, g1, wacc, g_end, (1 + g1) / (1 + wacc) AS q FROM yearly CROSS JOIN scen)
SELECT ticker, fiscal_year, scenario, round(fcf * q * (1 - pow(q, 10)) / (1 - q) + fcf * pow(q, 10) * (1 + g_end) / (wacc - g_end), 2) AS dcf, round((fcf * q * (1 - pow(q, 10)) / (1 - q) + fcf * pow(q, 10) * (1 + g_end) / (wacc - g_end) - 1000000) / (fcf * q * (1 - pow(q, 10)) / (1 - q) + fcf * pow(q, 10) * (1 + g_end) / (wacc - g_end)) * 100, 4) AS mos_pct FROM x""")
def dcf_scenarios(t: Tables) -> DataFrame:
    x = valuation.expand_scenarios(t.yearly().select("ticker", "fiscal_year", "revenue"))
    v = x.withColumn("v", valuation.two_stage_dcf(F.col("revenue"), F.col("g1"), F.col("wacc"), F.col("g_end"), 10))
    return v.select("ticker", "fiscal_year", "scenario", r("v", 2).alias("dcf"), r(valuation.margin_of_safety(F.col("v"), F.lit(1000000.0))).alias("mos_pct"))


@query(f"""WITH {STATEMENTS} SELECT ticker, fiscal_year, round(coalesce(net_income, 0) + coalesce(da, 0) + coalesce(sti, 0) - coalesce(capex, 0) - coalesce(inventory, 0), 2) AS owner_earnings FROM statements""")
def owner_earnings(t: Tables) -> DataFrame:
    s = t.statements()
    return s.select("ticker", "fiscal_year", r(valuation.owner_earnings(F.col("net_income"), F.col("da"), F.col("sti"), F.col("capex"), F.col("inventory")), 2).alias("owner_earnings"))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, CASE WHEN ticker % 5 = 0 THEN ticker % 2 = 0 ELSE coalesce(CASE WHEN ticker % 3 = 0 THEN true END, false) END AS skipped, round(revenue / pow(1.09::DOUBLE, n_orders), 4) AS pv, round(0.025::DOUBLE + (0.08::DOUBLE - 0.025::DOUBLE) * exp(-0.55::DOUBLE * n_orders), 8) AS blended FROM yearly""")
def forward_values(t: Tables) -> DataFrame:
    override = F.when(F.col("ticker") % 5 == 0, F.col("ticker") % 2 == 0)
    default = F.when(F.col("ticker") % 3 == 0, True)
    return t.yearly().select("ticker", "fiscal_year", valuation.skip(override, default).alias("skipped"), r(valuation.present_value(F.col("revenue"), F.lit(0.09), F.col("n_orders"))).alias("pv"), r(valuation.blend(F.lit(0.08), F.lit(0.025), F.col("n_orders")), 8).alias("blended"))


_RETURNS = BRAND_YEARS + """, rets AS (SELECT a.brand, a.fiscal_year, b.revenue / a.revenue - 1 AS ret FROM brand_years a JOIN brand_years b ON a.brand = b.brand AND b.fiscal_year = a.fiscal_year + 1 WHERE a.fiscal_year < 2001)"""


def _brand_returns(t: Tables) -> DataFrame:
    return backtest.returns(t.brand_years(), "brand", "fiscal_year", "revenue").filter("fiscal_year < 2001").select("brand", "fiscal_year", "ret")


@query(f"""WITH {_RETURNS}, c AS (SELECT *, 100 * exp(sum(ln(1 + ret)) OVER (PARTITION BY brand ORDER BY fiscal_year)) AS value FROM rets), p AS (SELECT *, greatest(100, max(value) OVER (PARTITION BY brand ORDER BY fiscal_year)) AS peak FROM c)
SELECT brand, fiscal_year, round(value, 4) AS value, round(CASE WHEN value >= peak - 1e-9 THEN 0.0::DOUBLE ELSE value / peak - 1 END, 6) AS drawdown FROM p""")
def backtest_curve(t: Tables) -> DataFrame:
    c = backtest.curve(_brand_returns(t), ["brand"], "fiscal_year", "ret")
    flat = F.when(F.col("value") >= F.col("peak") - 1e-9, 0.0).otherwise(F.col("drawdown"))
    return c.select("brand", "fiscal_year", r("value").alias("value"), r(flat, 6).alias("drawdown"))


@query(f"""WITH {_RETURNS}, c AS (SELECT *, 100 * exp(sum(ln(1 + ret)) OVER (PARTITION BY brand ORDER BY fiscal_year)) AS value FROM rets), p AS (SELECT *, greatest(100, max(value) OVER (PARTITION BY brand ORDER BY fiscal_year)) AS peak FROM c)
SELECT brand, round(pow(arg_max(value, fiscal_year) / 100, 1.0::DOUBLE / count(*)) - 1, 6) AS cagr, round(least(min(value / peak - 1), 0), 6) AS max_drawdown, round(stddev_samp(ret), 6) AS annual_vol, round((avg(ret) - 0.04::DOUBLE) / stddev_samp(ret), 4) AS sharpe, CAST(count(*) AS BIGINT) AS n_years FROM p GROUP BY 1""")
def backtest_statistics(t: Tables) -> DataFrame:
    s = backtest.statistics(_brand_returns(t), ["brand"], "fiscal_year", "ret")
    return s.select("brand", r("cagr", 6).alias("cagr"), r("max_drawdown", 6).alias("max_drawdown"), r("annual_vol", 6).alias("annual_vol"), r("sharpe").alias("sharpe"), "n_years")


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year FROM yearly WHERE revenue > 150000 AND n_orders <= 3 QUALIFY row_number() OVER (PARTITION BY fiscal_year ORDER BY revenue DESC, ticker) <= 30""")
def cohort_topk(t: Tables) -> DataFrame:
    rule = backtest.predicate([("revenue", ">", 150000), ("n_orders", "<=", 3)])
    return backtest.cohorts(t.yearly(), "fiscal_year", rule, [F.desc("revenue"), F.asc("ticker")]).select("ticker", "fiscal_year")


@query(f"""WITH {YEARLY}, k AS (SELECT ticker, fiscal_year, revenue FROM yearly WHERE revenue > 150000 QUALIFY row_number() OVER (PARTITION BY fiscal_year ORDER BY revenue DESC, ticker) <= 30)
SELECT k.fiscal_year, CAST(count(*) AS BIGINT) AS n_holdings, round(avg(n.revenue / k.revenue - 1), 6) AS portfolio_return FROM k JOIN yearly n ON n.ticker = k.ticker AND n.fiscal_year = k.fiscal_year + 1 GROUP BY 1""")
def cohort_returns(t: Tables) -> DataFrame:
    y = t.yearly()
    held = backtest.cohorts(y, "fiscal_year", F.col("revenue") > 150000, [F.desc("revenue"), F.asc("ticker")]).select("ticker", "fiscal_year")
    rets = backtest.returns(y, "ticker", "fiscal_year", "revenue").join(held, ["ticker", "fiscal_year"], "left_semi")
    return rets.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("n_holdings"), r(F.avg("ret"), 6).alias("portfolio_return"))


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(o_orderdate AS DATE) + 90 END AS VARCHAR) AS known FROM orders""")
def as_of_dates(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", backtest.as_of_date(F.when(F.col("o_orderkey") % 3 == 0, d), d).cast("string").alias("known"))


@query(f"""WITH {YEARLY}, v AS (SELECT ticker, fiscal_year, revenue - 50000 AS value FROM yearly) SELECT a.ticker, a.fiscal_year, CAST(h AS BIGINT) AS horizon, round(b.value, 2) AS future, round(CASE WHEN a.value > 0 AND b.value > 0 THEN ln(b.value) - ln(a.value) END, 6) AS log_growth, CAST(CASE WHEN b.value IS NOT NULL THEN CASE WHEN b.value < 0 THEN 1 ELSE 0 END END AS DOUBLE) AS is_loss
FROM v a CROSS JOIN (VALUES (1), (2), (3)) hs(h) LEFT JOIN v b ON a.ticker = b.ticker AND b.fiscal_year = a.fiscal_year + h""")
def panel_targets(t: Tables) -> DataFrame:
    v = t.yearly().select("ticker", "fiscal_year", (F.col("revenue") - 50000).alias("value"))
    p = forecast.training_panel(v, "ticker", "fiscal_year", "value", [1, 2, 3])
    return p.select("ticker", "fiscal_year", "horizon", r("future", 2).alias("future"), r("log_growth", 6).alias("log_growth"), F.col("is_loss").cast("double").alias("is_loss"))


@query("""WITH q AS (SELECT event_id, value, list_sort([value, value * 0.9, value * 1.1, value - 3]) AS s FROM events) SELECT event_id, round(s[1], 6) AS low, round(s[4], 6) AS high, round(CASE WHEN value - 20 <= 0 OR value / 100 >= 0.5 THEN 0.0::DOUBLE ELSE (value - 20) * exp(0.1::DOUBLE) END, 6) AS projected FROM q""")
def quantile_rearrange(t: Tables) -> DataFrame:
    v = F.col("value")
    s = forecast.rearranged([v, v * 0.9, v * 1.1, v - 3])
    return t.events.withColumn("s", s).select("event_id", r(F.get("s", F.lit(0)), 6).alias("low"), r(F.get("s", F.lit(3)), 6).alias("high"), r(forecast.hurdle(v - 20, F.lit(0.1), v / 100, 0.5), 6).alias("projected"))


@query("""WITH x AS (SELECT event_type, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS label, round(value) AS score FROM events), k AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY score) + (count(*) OVER (PARTITION BY event_type, score) - 1) / 2.0::DOUBLE AS rk FROM x)
SELECT event_type, round((sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS auc FROM k GROUP BY 1""")
def auc(t: Tables) -> DataFrame:
    x = t.events.select("event_type", F.when(F.col("user_id") % 2 == 0, 1).otherwise(0).alias("label"), F.round("value").alias("score"))
    return forecast.auc(x, ["event_type"], "label", "score").withColumn("auc", r("auc", 6))
