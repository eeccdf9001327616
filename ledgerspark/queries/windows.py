"""Window measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import growth, safe_div
from ledgerspark.operators import windows as op
from ledgerspark.operators.dedup import top_n
from ledgerspark.queries.registry import BRAND_YEARS, QUARTERLY, YEARLY, Tables, day, query, r


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, round(CASE WHEN prev <> 0 THEN (revenue - prev) / abs(prev) * 100 END, 4) AS yoy_pct FROM (SELECT *, lag(revenue) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS prev FROM yearly)""")
def yoy(t: Tables) -> DataFrame:
    return op.yoy(t.yearly(), ["ticker"], "fiscal_year", "revenue").select("ticker", "fiscal_year", r("yoy_pct").alias("yoy_pct"))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, round(CASE WHEN count(revenue) OVER w = 3 THEN avg(revenue) OVER w END, 2) AS mean3 FROM yearly WINDOW w AS (PARTITION BY ticker ORDER BY fiscal_year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def rolling_full(t: Tables) -> DataFrame:
    return t.yearly().select("ticker", "fiscal_year", r(op.full_mean("revenue", ["ticker"], "fiscal_year", 3), 2).alias("mean3"))


@query("""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS d, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1, 2)
SELECT event_type, CAST(d AS VARCHAR) AS d, round(CASE WHEN count(*) OVER a = 5 THEN avg(close) OVER a END, 4) AS sma5, round(CASE WHEN count(*) OVER b = 20 THEN avg(close) OVER b END, 4) AS sma20 FROM d
WINDOW a AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), b AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def sma(t: Tables) -> DataFrame:
    d = t.events.groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    return d.select("event_type", F.col("d").cast("string").alias("d"), *[r(op.full_mean("close", ["event_type"], "d", n)).alias(f"sma{n}") for n in (5, 20)])


@query(f"""WITH {YEARLY}, n AS (SELECT ticker, fiscal_year, fiscal_year - row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year) AS island FROM yearly)
SELECT ticker, min(fiscal_year) AS first_year, max(fiscal_year) AS last_year, CAST(count(*) AS BIGINT) AS length FROM n GROUP BY ticker, island""")
def gaps_islands(t: Tables) -> DataFrame:
    return op.islands(t.yearly(), ["ticker"], "fiscal_year")


@query(f"""WITH {YEARLY}, paid AS (SELECT ticker, fiscal_year FROM yearly WHERE n_orders >= 2), n AS (SELECT ticker, fiscal_year, fiscal_year - row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year) AS island FROM paid),
i AS (SELECT ticker, max(fiscal_year) AS last_year, count(*) AS length FROM n GROUP BY ticker, island), a AS (SELECT ticker, max(fiscal_year) AS anchor FROM paid GROUP BY 1)
SELECT ticker, CAST(max(length) AS BIGINT) AS streak FROM i JOIN a USING (ticker) WHERE last_year >= anchor - 1 GROUP BY 1""")
def dividend_streak(t: Tables) -> DataFrame:
    return op.streak(t.yearly().filter("n_orders >= 2"), ["ticker"], "fiscal_year")


@query(f"""WITH {YEARLY}, l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM yearly) SELECT ticker FROM l WHERE rn <= 3 GROUP BY 1 HAVING count(*) = 3 AND count(*) FILTER (revenue >= 100000) = 3""")
def sustained_n(t: Tables) -> DataFrame:
    return op.sustained(t.yearly(), ["ticker"], "fiscal_year", F.col("revenue") >= 100000, 3)


@query(f"""WITH {YEARLY}, a AS (SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS newest FROM yearly), e AS (SELECT ticker, avg(revenue) FILTER (fiscal_year > newest - 3) AS late, count(*) FILTER (fiscal_year > newest - 3) AS nl, avg(revenue) FILTER (fiscal_year BETWEEN newest - 5 AND newest - 3) AS early, count(*) FILTER (fiscal_year BETWEEN newest - 5 AND newest - 3) AS ne FROM a GROUP BY 1)
SELECT ticker, round(late / early, 4) AS growth FROM e WHERE nl = 3 AND ne = 3 AND early > 0""")
def endpoint_growth(t: Tables) -> DataFrame:
    a = t.yearly().withColumn("newest", F.max("fiscal_year").over(Window.partitionBy("ticker")))
    late, early = F.col("fiscal_year") > F.col("newest") - 3, F.col("fiscal_year").between(F.col("newest") - 5, F.col("newest") - 3)
    e = a.groupBy("ticker").agg(F.avg(F.when(late, F.col("revenue"))).alias("l"), F.count_if(late).alias("nl"), F.avg(F.when(early, F.col("revenue"))).alias("e"), F.count_if(early).alias("ne"))
    return e.filter("nl = 3 AND ne = 3 AND e > 0").select("ticker", r(F.col("l") / F.col("e")).alias("growth"))


@query(f"""WITH {YEARLY}, s AS (SELECT *, CASE WHEN fiscal_year - lag(fiscal_year) OVER w = 1 AND revenue > 0 AND lag(revenue) OVER w > 0 THEN ln(revenue) - ln(lag(revenue) OVER w) END AS step FROM yearly WINDOW w AS (PARTITION BY ticker ORDER BY fiscal_year))
SELECT ticker, fiscal_year, round(CASE WHEN count(step) OVER f >= 3 THEN avg(step) OVER f END, 4) AS trend FROM s WINDOW f AS (PARTITION BY ticker ORDER BY fiscal_year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def growth_trend(t: Tables) -> DataFrame:
    return op.growth_trend(t.yearly(), ["ticker"], "fiscal_year", "revenue").select("ticker", "fiscal_year", r("trend").alias("trend"))


@query(f"""WITH {QUARTERLY}, l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year * 10 + quarter DESC) AS rn FROM quarterly) SELECT ticker, round(sum(revenue), 2) AS ttm, max(CASE WHEN rn = 1 THEN revenue END) AS latest FROM l WHERE rn <= 4 GROUP BY 1 HAVING count(revenue) = 4""")
def ttm_last4(t: Tables) -> DataFrame:
    q = t.quarterly().withColumn("slot", F.col("fiscal_year") * 10 + F.col("quarter"))
    return op.trailing(q, ["ticker"], "slot", "revenue").withColumn("ttm", r("ttm", 2))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, CASE WHEN count(revenue) OVER w >= 3 AND avg(revenue) OVER w <> 0 THEN CASE WHEN (revenue - avg(revenue) OVER w) / abs(avg(revenue) OVER w) * 100 > 20 THEN 'above' WHEN (revenue - avg(revenue) OVER w) / abs(avg(revenue) OVER w) * 100 < -20 THEN 'below' ELSE 'normal' END END AS signal
FROM yearly WINDOW w AS (PARTITION BY ticker ORDER BY fiscal_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def own_history_signal(t: Tables) -> DataFrame:
    return t.yearly().select("ticker", "fiscal_year", op.own_history_signal("revenue", ["ticker"], "fiscal_year").alias("signal"))


@query("""WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id FROM n WHERE (rn - 1) % CAST(ceil(n / 10.0) AS BIGINT) = 0 OR rn = n""")
def downsample(t: Tables) -> DataFrame:
    return op.downsample(t.events.withColumn("o", F.struct("ts", "event_id")), ["user_id"], "o", 10).select("user_id", "event_id")


@query("""SELECT user_id, event_id FROM events QUALIFY date_diff('day', CAST(ts AS DATE), CAST(max(ts) OVER (PARTITION BY user_id) AS DATE)) <= 7""")
def trailing_window(t: Tables) -> DataFrame:
    return op.trailing_window(t.events, ["user_id"], "ts", 7).select("user_id", "event_id")


@query(f"""WITH {BRAND_YEARS}, m AS (SELECT brand, fiscal_year, revenue / 1e6 AS roa, revenue AS ocf, quantity * 1000.0::DOUBLE AS net_income, quantity / revenue AS leverage, revenue / quantity AS current_ratio, quantity AS shares, revenue % 1000 AS gross_margin, revenue % 77 AS asset_turnover FROM brand_years)
SELECT brand, fiscal_year, CAST(CASE WHEN lag(fiscal_year) OVER w IS NOT NULL THEN (CASE WHEN roa > 0 THEN 1 ELSE 0 END) + (CASE WHEN ocf > 0 THEN 1 ELSE 0 END) + (CASE WHEN roa > lag(roa) OVER w THEN 1 ELSE 0 END) + (CASE WHEN ocf > net_income THEN 1 ELSE 0 END) + (CASE WHEN leverage < lag(leverage) OVER w THEN 1 ELSE 0 END)
 + (CASE WHEN current_ratio > lag(current_ratio) OVER w THEN 1 ELSE 0 END) + (CASE WHEN shares <= lag(shares) OVER w THEN 1 ELSE 0 END) + (CASE WHEN gross_margin > lag(gross_margin) OVER w THEN 1 ELSE 0 END) + (CASE WHEN asset_turnover > lag(asset_turnover) OVER w THEN 1 ELSE 0 END) END AS DOUBLE) AS f_score FROM m WINDOW w AS (PARTITION BY brand ORDER BY fiscal_year)""")
def f_score(t: Tables) -> DataFrame:
    b, v, q = t.brand_years(), F.col("revenue"), F.col("quantity")
    m = b.select("brand", "fiscal_year", (v / 1e6).alias("roa"), v.alias("ocf"), (q * 1000.0).alias("net_income"), (q / v).alias("leverage"), (v / q).alias("current_ratio"), q.alias("shares"), (v % 1000).alias("gross_margin"), (v % 77).alias("asset_turnover"))
    return op.f_score(m, ["brand"], "fiscal_year").select("brand", "fiscal_year", F.col("f_score").cast("double").alias("f_score"))


@query(f"""WITH {YEARLY}, l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM yearly) SELECT ticker, round(avg(revenue), 6) AS mean FROM l WHERE rn <= 10 GROUP BY 1 HAVING count(*) >= 2""")
def mean_last10(t: Tables) -> DataFrame:
    last = top_n(t.yearly(), ["ticker"], [F.desc("fiscal_year")], 10)
    return last.groupBy("ticker").agg(F.avg("revenue").alias("mean"), F.count(F.lit(1)).alias("n")).filter("n >= 2").select("ticker", r("mean", 6).alias("mean"))


@query(f"""WITH {BRAND_YEARS} SELECT brand, round(regr_slope(ln(revenue), fiscal_year), 4) AS slope, round(regr_r2(ln(revenue), fiscal_year), 4) AS r2 FROM brand_years WHERE revenue > 0 GROUP BY 1 HAVING count(*) >= 3""")
def trend_fit(t: Tables) -> DataFrame:
    b = t.brand_years().filter("revenue > 0")
    y, x = F.ln("revenue"), F.col("fiscal_year").cast("double")
    fit = b.groupBy("brand").agg(F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n"))
    return fit.filter("n >= 3").select("brand", r("slope").alias("slope"), r("r2").alias("r2"))


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1, 2)
SELECT user_id, arg_max(close, d) AS latest, min(close) AS low, max(close) AS high, round(CASE WHEN max(close) > min(close) THEN (arg_max(close, d) - min(close)) / (max(close) - min(close)) END, 4) AS position, round(CASE WHEN arg_min(close, d) <> 0 THEN (arg_max(close, d) - arg_min(close, d)) / abs(arg_min(close, d)) * 100 END, 4) AS change_pct, CAST(max(d) AS VARCHAR) AS last_day FROM d GROUP BY 1""")
def price_kpis(t: Tables) -> DataFrame:
    d = t.events.groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    k = d.groupBy("user_id").agg(F.max_by("close", "d").alias("latest"), F.min("close").alias("low"), F.max("close").alias("high"), F.min_by("close", "d").alias("first"), F.max("d").alias("last_day"))
    return k.select("user_id", "latest", "low", "high", r(safe_div(F.col("latest") - F.col("low"), F.col("high") - F.col("low"))).alias("position"), r(growth("latest", "first")).alias("change_pct"), day("last_day").alias("last_day"))
