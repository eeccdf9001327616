"""Preset screens, the liquidation screen, pages, runs, coverage and neighbour checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators import asof as op
from ledgerspark.operators import checks, clean, presets, quality, reshape, screener
from ledgerspark.queries import further
from ledgerspark.queries.registry import METRICS, ORACLES, YEARLY, Tables, day, query, r

_FIGURES = """figures AS (SELECT p_partkey AS ticker, p_size % 25 / 10.0::DOUBLE AS cr, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey % 30 END AS pe, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 7 / 2.0::DOUBLE END AS pb,
  p_size % 11 / 10.0::DOUBLE AS de, p_partkey % 80 AS gm, p_partkey % 35 AS nm, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS mos, p_partkey % 28 AS roe, p_partkey % 19 / 10.0::DOUBLE AS peg FROM part)"""
_RULES = {
    ("graham", "strict"): "cr >= 2.0 AND pe <= 15 AND (pb <= 1.5 OR pe * pb <= 22.5)", ("graham", "moderate"): "cr >= 1.75 AND pe <= 17.5 AND (pb <= 2 OR pe * pb <= 26)", ("graham", "relaxed"): "cr >= 1.5 AND pe <= 20 AND (pb <= 2.5 OR pe * pb <= 30)",
    ("buffett", "strict"): "de <= 0.35 AND gm > 50 AND nm > 25 AND (mos IS NULL OR mos >= 33)", ("buffett", "moderate"): "de <= 0.5::DOUBLE AND gm > 40 AND nm > 20 AND (mos IS NULL OR mos >= 25)", ("buffett", "relaxed"): "de <= 0.75 AND gm > 30 AND nm > 12 AND (mos IS NULL OR mos >= 15)",
    ("lynch", "strict"): "de < 0.4::DOUBLE AND cr >= 1.5 AND roe > 20 AND peg < 0.75", ("lynch", "moderate"): "de < 0.6::DOUBLE AND cr >= 1 AND roe > 15 AND peg < 1", ("lynch", "relaxed"): "de < 1 AND cr >= 0.8::DOUBLE AND roe > 10 AND peg < 1.5",
}


@query(f"WITH {_FIGURES} " + " UNION ALL ".join(f"SELECT ticker, '{p}' AS preset, '{level}' AS level FROM figures WHERE {rule}" for (p, level), rule in _RULES.items()))
def preset_levels(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    figures = t.part.select(
        k.alias("ticker"), (s % 25 / 10.0).alias("current_ratio"), F.when(k % 11 != 0, k % 30).alias("pe"), F.when(k % 13 != 0, k % 7 / 2.0).alias("pb"), (s % 11 / 10.0).alias("debt_equity"),
        (k % 80).alias("gross_margin"), (k % 35).alias("net_margin"), F.when(k % 3 != 0, s).alias("mos"), (k % 28).alias("roe"), (k % 19 / 10.0).alias("peg"),
    )
    passed = [F.when(presets.latest_rule(p, level), F.struct(F.lit(p).alias("preset"), F.lit(level).alias("level"))) for p in presets.THRESHOLDS for level in presets.LEVELS]
    return figures.select("ticker", F.explode(F.filter(F.array(*passed), lambda x: x.isNotNull())).alias("p")).select("ticker", "p.preset", "p.level")


_SERIES = """series AS (SELECT o_custkey // 3 AS ticker, year(o_orderdate) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS y, sum(CASE WHEN o_orderkey % 7 = 1 THEN -2 ELSE 1 END) AS ni,
  CASE WHEN count(*) FILTER (o_orderkey % 5 <> 0) > 0 THEN count(*) FILTER (o_orderkey % 5 <> 0) END AS dy, max(CASE WHEN o_orderkey % 4 <> 0 THEN round(o_totalprice) END) AS eps, 10 + 3 * count(*) AS roe FROM orders GROUP BY 1, 2)"""


def _lasting(column: str, least: float, n: int) -> str:
    return f"SELECT ticker FROM (SELECT * FROM series WHERE {column} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY y DESC) <= {n}) GROUP BY 1 HAVING count(*) = {n} AND min({column}) >= {least}"


def _years_sql(earn: int, div: int, div_least: int, eps: str) -> str:
    paid = f"""SELECT ticker FROM (SELECT d.*, row_number() OVER (PARTITION BY ticker ORDER BY y DESC) AS rn, max(y) OVER (PARTITION BY ticker) AS last FROM series d WHERE dy >= 0) JOIN (SELECT ticker, max(y) AS newest FROM series GROUP BY 1) USING (ticker)
      WHERE rn <= {div} GROUP BY ticker, newest, last HAVING count(*) FILTER (y + rn = last + 1) >= {div_least} AND last >= newest - 1"""
    return f"{_lasting('ni', 0, earn)} INTERSECT ({paid}) INTERSECT ({eps})"


_KNOWN = "(SELECT *, max(y) OVER (PARTITION BY ticker) AS newest FROM series WHERE eps IS NOT NULL)"
_AVERAGED = f"SELECT ticker FROM {_KNOWN} GROUP BY 1 HAVING count(*) FILTER (y > newest - 3) = 3 AND count(*) FILTER (y BETWEEN newest - 9 AND newest - 7) = 3 AND avg(eps) FILTER (y > newest - 3) >= 1.33::DOUBLE * avg(eps) FILTER (y BETWEEN newest - 9 AND newest - 7)"
_ENDS = "SELECT a.ticker FROM {0} a JOIN {0} b ON a.ticker = b.ticker AND a.y = a.newest AND b.y = a.newest - {1} WHERE a.eps >= 1.33::DOUBLE * b.eps"
_BY_LEVEL = {
    ("graham", "strict"): _years_sql(10, 10, 10, _AVERAGED), ("graham", "moderate"): _years_sql(7, 7, 5, _ENDS.format(_KNOWN, 7)), ("graham", "relaxed"): _years_sql(5, 5, 3, _ENDS.format(_KNOWN, 5)),
    ("buffett", "strict"): _lasting("roe", 15, 10), ("buffett", "moderate"): _lasting("roe", 15, 5), ("buffett", "relaxed"): _lasting("roe", 12, 3),
}


@query(f"WITH {_SERIES} " + " UNION ALL ".join(f"SELECT CAST(ticker AS BIGINT) AS ticker, '{p}' AS preset, '{level}' AS level FROM ({sql})" for (p, level), sql in _BY_LEVEL.items()))
def preset_years(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    half = F.year("o_orderdate") * 2 + F.when(F.month("o_orderdate") > 6, 1).otherwise(0)
    paying = F.count_if(k % 5 != 0)
    series = t.orders.groupBy(F.floor(F.col("o_custkey") / 3).cast("long").alias("ticker"), half.alias("fiscal_year")).agg(
        F.sum(F.when(k % 7 == 1, -2).otherwise(1)).alias("net_income"), F.when(paying > 0, paying).alias("dividend_yield"), F.max(F.when(k % 4 != 0, F.round("o_totalprice"))).alias("eps"), (10 + 3 * F.count(F.lit(1))).alias("roe"),
    )
    one = lambda p, level: presets.multi_year(series, p, level).select("ticker", F.lit(p).alias("preset"), F.lit(level).alias("level"))
    return reduce(DataFrame.unionByName, [one(p, level) for p, level in _BY_LEVEL])


_CANDIDATES = "candidates AS (SELECT p_partkey AS ticker, CASE WHEN p_partkey % 17 <> 0 THEN p_size / 30.0::DOUBLE END AS ratio, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 10 END AS f FROM part)"


def _candidates(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("ticker"), F.when(k % 17 != 0, F.col("p_size") / 30.0).alias("ratio"), F.when(k % 9 != 0, k % 10).alias("f"))


@query(f"WITH {_CANDIDATES} SELECT ticker, round(ratio, 6) AS ratio FROM candidates WHERE (f IS NULL OR f >= 4) AND ratio < 0.85::DOUBLE")
def net_nets_without_traps(t: Tables) -> DataFrame:
    return presets.net_nets(_candidates(t), "ratio", "f", True, 15.0).select("ticker", r("ratio", 6).alias("ratio"))


@query(f"WITH {_CANDIDATES} SELECT CAST(count(*) AS BIGINT) AS eligible, CAST(count(*) FILTER (ratio < 1) AS BIGINT) AS below_value, CAST(count(*) FILTER (ratio <= 0.67) AS BIGINT) AS classic FROM candidates WHERE f IS NULL OR f >= 4")
def net_net_counts(t: Tables) -> DataFrame:
    return presets.net_net_stats(presets.net_nets(_candidates(t), "ratio", "f", True), "ratio")


@query("SELECT c_custkey, CAST((SELECT count(*) FROM customer) AS BIGINT) AS total FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25 OFFSET 50")
def page_with_total(t: Tables) -> DataFrame:
    found, total = screener.counted_page(t.customer, [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")], 2, 25)
    return found.select("c_custkey", F.lit(total).cast("long").alias("total"))


@query("SELECT o_orderkey, round(o_totalprice - 150000, 2) AS off FROM orders ORDER BY abs(o_totalprice - 150000) DESC, o_orderkey LIMIT 20")
def worst_differences(t: Tables) -> DataFrame:
    return checks.worst(t.orders, F.col("o_totalprice") - 150000, [F.asc("o_orderkey")]).select("o_orderkey", r(F.col("o_totalprice") - 150000, 2).alias("off"))


@query("""WITH s AS (SELECT *, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sma FROM events)
SELECT user_id, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month, arg_max(value, (ts, event_id)) AS value, round(arg_max(sma, (ts, event_id)), 4) AS sma FROM s GROUP BY 1, 2""")
def resample_monthly(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    e = reshape.resample(t.events.withColumn("sma", F.avg("value").over(w)), ["user_id"], "ts", "month", "value", "event_id", ["sma"])
    return e.select("user_id", day("period").alias("month"), "value", r("sma").alias("sma"))


@query(f"SELECT status, reason, CAST(count(*) AS BIGINT) AS n FROM ({ORACLES['admission_chain']}) GROUP BY 1, 2")
def admission_funnel(t: Tables) -> DataFrame:
    return checks.funnel(further.admission_chain(t), "status", "reason")


@query(f"WITH {YEARLY} SELECT max(fiscal_year) AS newest, CASE WHEN max(fiscal_year) > 2000 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM yearly")
def newest_year_bound(t: Tables) -> DataFrame:
    return checks.year_bound(t.yearly(), "fiscal_year", F.lit(2000))


@query(f"""WITH {METRICS}, o AS (SELECT ticker, fiscal_year FROM metrics WHERE metric = 'orders'), a AS (SELECT DISTINCT ticker, fiscal_year FROM metrics WHERE metric IN ('orders', 'average'))
SELECT a.ticker, CAST(count(o.fiscal_year) AS BIGINT) AS own_years, CAST(count(*) AS BIGINT) AS all_years, coalesce(string_agg(CAST(a.fiscal_year AS VARCHAR), ',' ORDER BY a.fiscal_year) FILTER (o.fiscal_year IS NULL), '') AS gained FROM a LEFT JOIN o USING (ticker, fiscal_year) GROUP BY 1""")
def synonym_years(t: Tables) -> DataFrame:
    found = checks.synonym_coverage(t.metrics(), "ticker", "metric", "fiscal_year", "orders", ["average"])
    return found.withColumn("gained", F.array_join(F.transform("gained", lambda y: y.cast("string")), ","))


@query("""WITH p AS (SELECT DISTINCT o_custkey FROM orders) SELECT CAST(count(*) AS BIGINT) AS present, CAST(count(*) FILTER (o_custkey % 10 <> 0) AS BIGINT) AS covered, round(count(*) FILTER (o_custkey % 10 <> 0) / CAST(count(*) AS DOUBLE), 6) AS share, count(*) FILTER (o_custkey % 10 = 0) = 0 AS contained FROM p""")
def scope_coverage(t: Tables) -> DataFrame:
    scope = t.customer.filter("c_custkey % 10 <> 0").withColumnRenamed("c_custkey", "ticker")
    return checks.coverage(scope, t.orders.withColumnRenamed("o_custkey", "ticker"), "ticker").withColumn("share", r("share", 6))


@query("""WITH x AS (SELECT user_id AS run, min(ts) AS started, CAST(count(*) AS BIGINT) AS n_steps, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS n_failed, CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS n_skipped, round(sum(value), 2) AS total_minutes FROM events GROUP BY 1)
SELECT run, n_steps, n_failed, n_skipped, total_minutes FROM x ORDER BY started DESC, run DESC LIMIT 10""")
def last_runs(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("done")
    found = checks.run_trend(t.events.select(F.col("user_id").alias("run"), "ts", "value", status.alias("status")), "run", "ts", "value", "status", 10)
    return found.select("run", "n_steps", "n_failed", "n_skipped", r("total_minutes", 2).alias("total_minutes"))


@query("""WITH n AS (SELECT c_nationkey AS c, count(*) AS n, max(c_custkey % 3) AS s FROM customer GROUP BY 1), b AS (SELECT c_nationkey AS c, count(*) AS before, max(c_custkey % 3) AS s FROM customer WHERE c_custkey % 3 <> 2 OR c_nationkey % 2 = 0 GROUP BY 1)
SELECT n.c, CASE WHEN before IS NULL THEN 'new' WHEN n.n - before >= 1000 AND n.n - before >= 0.2 * before THEN 'grown' WHEN n.s > b.s THEN 'worse' ELSE 'steady' END AS change FROM n LEFT JOIN b USING (c)""")
def worse_clusters(t: Tables) -> DataFrame:
    count = lambda df: df.groupBy(F.col("c_nationkey").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("c_custkey") % 3).alias("severity"))
    return quality.cluster_growth(count(t.customer), count(t.customer.filter("c_custkey % 3 <> 2 OR c_nationkey % 2 = 0")), ["c"], 1000).select("c", "change")


@query("""SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 3""")
def spiked_neighbours(t: Tables) -> DataFrame:
    """The third value of each user is planted 1,000 times too large; the rounds clear the value after it."""
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    planted = t.events.select("user_id", "event_id", (F.lit(100.0) + F.col("user_id") % 50).alias("base"), nth.alias("nth")).withColumn("value", F.when(F.col("nth") == 3, F.col("base") * 1000).otherwise(F.col("base")))
    return clean.implausible_neighbours(planted, ["user_id"], "event_id", "value").filter("suspect").select("event_id")


@query("""WITH q AS (SELECT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS qd, o_orderpriority = '1-URGENT' AS annual, o_totalprice AS amount FROM orders),
b AS (SELECT c, arg_max(annual, (qd, annual, amount)) AS annual, arg_max(amount, (qd, annual, amount)) AS amount, max(qd) AS qd FROM q WHERE qd <= DATE '2000-06-30' GROUP BY 1)
SELECT c_custkey, annual, amount FROM customer LEFT JOIN (SELECT * FROM b WHERE date_diff('day', qd, DATE '2000-06-30') <= 400) ON c = c_custkey""")
def asof_annual_first(t: Tables) -> DataFrame:
    quotes = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.date_trunc("month", "o_orderdate").cast("date").alias("qd"), (F.col("o_orderpriority") == "1-URGENT").alias("annual"), F.col("o_totalprice").alias("amount"))
    targets = t.customer.select("c_custkey", F.lit("2000-06-30").cast("date").alias("at"))
    return op.asof(targets, quotes, ["c_custkey"], "at", "qd", ["annual", "amount"], 400).select("c_custkey", "annual", "amount")
