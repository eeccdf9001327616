"""Further queries: filters, set operations, plausibility, audits, grids and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import over_positive
from ledgerspark.operators import asof as op
from ledgerspark.operators import clean, forecast, quality, reshape, valuation, windows
from ledgerspark.operators.dedup import latest, retain_recent, top_n
from ledgerspark.queries.registry import BRAND_YEARS, QUARTERLY, STATEMENTS, YEARLY, Tables, query, r


@query("""SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""")
def latest_scrape(t: Tables) -> DataFrame:
    o = t.orders.withColumn("d", F.col("o_orderdate").cast("date"))
    newest = o.agg(F.max("d").alias("d"))
    return o.join(F.broadcast(newest), "d", "left_semi").select("o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS alias FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')""")
def pair_filter(t: Tables) -> DataFrame:
    pairs = t.spark.createDataFrame([("F", "1-URGENT", "done"), ("O", "5-LOW", "open")], "o_orderstatus string, o_orderpriority string, alias string")
    return t.orders.join(F.broadcast(pairs), ["o_orderstatus", "o_orderpriority"]).select("o_orderkey", "alias")


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, CAST(NULL AS VARCHAR), s_acctbal FROM supplier""")
def union_typed_nulls(t: Tables) -> DataFrame:
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1996), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1997) SELECT k, 'only 1996' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'only 1997' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def symmetric_difference(t: Tables) -> DataFrame:
    of = lambda y: t.orders.filter(F.year("o_orderdate") == y).select(F.col("o_custkey").alias("k"))
    a, b = of(1996), of(1997)
    return clean.orphans(a, b, ["k"]).withColumn("side", F.lit("only 1996")).unionByName(clean.orphans(b, a, ["k"]).withColumn("side", F.lit("only 1997")))


@query(f"""WITH {YEARLY}, s AS (SELECT ticker, fiscal_year - lag(fiscal_year) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS step, fiscal_year FROM yearly)
SELECT ticker, CAST(count(*) AS BIGINT) AS years, CAST(coalesce(max(step), 1) AS BIGINT) AS widest, count(*) < 5 AS short FROM s GROUP BY 1 HAVING coalesce(max(step), 1) >= 2 OR count(*) < 5""")
def history_audit(t: Tables) -> DataFrame:
    step = F.col("fiscal_year") - F.lag("fiscal_year").over(Window.partitionBy("ticker").orderBy("fiscal_year"))
    a = t.yearly().withColumn("step", step).groupBy("ticker").agg(F.count(F.lit(1)).alias("years"), F.coalesce(F.max("step"), F.lit(1)).cast("long").alias("widest"))
    return a.filter("widest >= 2 OR years < 5").withColumn("short", F.col("years") < 5)


@query("""SELECT o_custkey AS ticker, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS statements FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1""")
def concept_in_two_statements(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("ticker")).agg(F.count_distinct("o_orderstatus").alias("statements")).filter("statements > 1")


@query("""WITH c AS (SELECT o.o_orderkey, max(CASE WHEN abs(l.l_extendedprice - o.o_totalprice) <= 0.1 * o.o_totalprice THEN 1 ELSE 0 END) AS any_match, max(CASE WHEN l.l_extendedprice < o.o_totalprice THEN 1 ELSE 0 END) AS any_less FROM orders o JOIN lineitem l ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_orderkey, CASE WHEN any_match = 1 THEN 'match' WHEN any_less = 1 THEN 'less' ELSE 'more' END AS verdict FROM c""")
def best_of_group(t: Tables) -> DataFrame:
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    near = F.abs(F.col("l_extendedprice") - F.col("o_totalprice")) <= 0.1 * F.col("o_totalprice")
    c = j.groupBy("o_orderkey").agg(F.max(near.cast("int")).alias("m"), F.max((F.col("l_extendedprice") < F.col("o_totalprice")).cast("int")).alias("s"))
    return c.select("o_orderkey", F.when(F.col("m") == 1, "match").when(F.col("s") == 1, "less").otherwise("more").alias("verdict"))


@query(f"""WITH {YEARLY} SELECT DISTINCT a.ticker, a.fiscal_year FROM yearly a JOIN yearly b ON a.ticker = b.ticker AND a.fiscal_year <> b.fiscal_year AND abs(a.revenue - b.revenue) <= 0.01 * a.revenue""")
def period_misalignment(t: Tables) -> DataFrame:
    a = t.yearly().select("ticker", "fiscal_year", "revenue")
    b = a.select("ticker", F.col("fiscal_year").alias("y"), F.col("revenue").alias("v"))
    hit = (F.col("fiscal_year") != F.col("y")) & (F.abs(F.col("revenue") - F.col("v")) <= 0.01 * F.col("revenue"))
    return op.within(a, b, ["ticker"], hit).filter("matched").select("ticker", "fiscal_year")


@query(f"""WITH {YEARLY}, m AS (SELECT *, median(revenue) OVER (PARTITION BY ticker) AS ref FROM yearly) SELECT ticker, fiscal_year, CASE WHEN revenue > 4 * ref THEN 'high' WHEN revenue < ref / 5 THEN 'low' END AS reason FROM m WHERE revenue > 4 * ref OR revenue < ref / 5""")
def plausibility_reference(t: Tables) -> DataFrame:
    ref = t.yearly().groupBy("ticker").agg(F.median("revenue").alias("ref"))
    m = t.yearly().join(ref, "ticker")
    return m.select("ticker", "fiscal_year", F.when(F.col("revenue") > 4 * F.col("ref"), "high").when(F.col("revenue") < F.col("ref") / 5, "low").alias("reason")).filter("reason IS NOT NULL")


@query("""WITH d AS (SELECT o_custkey AS ticker, o_orderstatus AS concept, CAST(year(o_orderdate) AS BIGINT) AS fy, o_orderkey, CAST(o_orderdate AS DATE) AS pe FROM orders), k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY ticker, concept, pe ORDER BY (o_orderkey % 4 = 0) DESC, fy, o_orderkey) = 1)
SELECT ticker, concept, o_orderkey FROM k QUALIFY row_number() OVER (PARTITION BY ticker, concept, fy, quarter(pe) ORDER BY pe DESC, o_orderkey DESC) = 1""")
def stock_quarters(t: Tables) -> DataFrame:
    d = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("concept"), F.year("o_orderdate").alias("fy"), "o_orderkey", F.col("o_orderdate").cast("date").alias("pe"), F.quarter("o_orderdate").alias("q"))
    k = top_n(d, ["ticker", "concept", "pe"], [(F.col("o_orderkey") % 4 == 0).desc(), F.asc("fy"), F.asc("o_orderkey")])
    return top_n(k, ["ticker", "concept", "fy", "q"], [F.desc("pe"), F.desc("o_orderkey")]).select("ticker", "concept", "o_orderkey")


@query(f"""WITH {QUARTERLY}, k AS (SELECT *, dense_rank() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rk FROM quarterly) SELECT ticker, fiscal_year, max(CASE WHEN quarter = 1 THEN revenue END) AS q1, max(CASE WHEN quarter = 2 THEN revenue END) AS q2, max(CASE WHEN quarter = 3 THEN revenue END) AS q3, max(CASE WHEN quarter = 4 THEN revenue END) AS q4 FROM k WHERE rk <= 3 GROUP BY 1, 2""")
def quarter_grid(t: Tables) -> DataFrame:
    q = retain_recent(t.quarterly(), ["ticker"], "fiscal_year", 3).withColumn("label", F.concat(F.lit("Q"), F.col("quarter").cast("string")))
    return reshape.widen(q, ["ticker", "fiscal_year"], "label", "revenue", ["Q1", "Q2", "Q3", "Q4"])


@query(f"""WITH {YEARLY} SELECT ticker, array_to_string(list(fiscal_year ORDER BY fiscal_year), ',') AS years, round(min(revenue), 2) AS low, round(max(revenue), 2) AS high FROM yearly GROUP BY 1""")
def series_by_key(t: Tables) -> DataFrame:
    return t.yearly().groupBy("ticker").agg(F.array_join(F.array_sort(F.collect_list("fiscal_year")).cast("array<string>"), ",").alias("years"), r(F.min("revenue"), 2).alias("low"), r(F.max("revenue"), 2).alias("high"))


@query(f"""WITH {STATEMENTS}, {YEARLY}, j AS (SELECT a.ticker, a.fiscal_year, b.fiscal_year AS base_year, a.revenue, b.revenue AS base, row_number() OVER (PARTITION BY a.ticker, a.fiscal_year ORDER BY b.fiscal_year) AS rn FROM yearly a JOIN yearly b ON a.ticker = b.ticker AND b.fiscal_year BETWEEN a.fiscal_year - 5 AND a.fiscal_year - 3 AND b.revenue > 0),
c AS (SELECT ticker, fiscal_year, (pow(revenue / base, 1.0::DOUBLE / (fiscal_year - base_year)) - 1) * 100 AS cagr FROM j WHERE rn = 1), p AS (SELECT ticker, fiscal_year, CASE WHEN net_income > 0 THEN market_cap / net_income END AS pe FROM statements)
SELECT ticker, fiscal_year, round(CASE WHEN cagr > 0.5 THEN pe / cagr END, 4) AS peg FROM p JOIN c USING (ticker, fiscal_year)""")
def peg(t: Tables) -> DataFrame:
    b = op.earliest_base(t.yearly(), ["ticker"], "fiscal_year", "revenue").filter("base_year IS NOT NULL")
    c = b.select("ticker", "fiscal_year", ((F.pow(F.col("revenue") / F.col("base_value"), 1.0 / (F.col("fiscal_year") - F.col("base_year"))) - 1) * 100).alias("cagr"))
    p = t.statements().select("ticker", "fiscal_year", over_positive("market_cap", "net_income").alias("pe"))
    return p.join(c, ["ticker", "fiscal_year"]).select("ticker", "fiscal_year", r(F.when(F.col("cagr") > 0.5, F.col("pe") / F.col("cagr"))).alias("peg"))


@query(f"""WITH {BRAND_YEARS}, g AS (SELECT brand, fiscal_year, CASE WHEN lag(quantity) OVER w <> 0 THEN (quantity - lag(quantity) OVER w) * 100.0::DOUBLE / abs(lag(quantity) OVER w) END AS change FROM brand_years WINDOW w AS (PARTITION BY brand ORDER BY fiscal_year)) SELECT brand, fiscal_year, round(0 - change, 4) AS net_buyback_yield FROM g""")
def net_buyback_yield(t: Tables) -> DataFrame:
    g = windows.yoy(t.brand_years(), ["brand"], "fiscal_year", "quantity")
    return g.select("brand", "fiscal_year", r(0 - F.col("yoy_pct")).alias("net_buyback_yield"))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, CAST(CASE WHEN fiscal_year <= 1998 THEN 1 ELSE 2 END AS BIGINT) AS fold FROM yearly WHERE fiscal_year <= 2000""")
def walk_forward(t: Tables) -> DataFrame:
    y = t.yearly()
    (train, test), = forecast.walk_forward(y, "fiscal_year", [1998, 2000])
    return train.select("ticker", "fiscal_year", F.lit(1).cast("long").alias("fold")).unionByName(test.select("ticker", "fiscal_year", F.lit(2).cast("long").alias("fold")))


@query(f"""WITH {YEARLY}, {QUARTERLY}, l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year * 10 + quarter DESC) AS rn FROM quarterly), ttm AS (SELECT ticker, sum(revenue) AS ttm FROM l WHERE rn <= 4 GROUP BY 1 HAVING count(*) = 4), cap AS (SELECT ticker, arg_max(revenue, fiscal_year) * 5 AS cap FROM yearly GROUP BY 1)
SELECT ticker, round(cap / ttm, 4) AS live_ps FROM ttm JOIN cap USING (ticker) WHERE ttm > 0""")
def live_multiple(t: Tables) -> DataFrame:
    ttm = windows.trailing(t.quarterly().withColumn("slot", F.col("fiscal_year") * 10 + F.col("quarter")), ["ticker"], "slot", "revenue")
    cap = latest(t.yearly().select("ticker", "fiscal_year", "revenue"), ["ticker"], ["fiscal_year"]).select("ticker", (F.col("revenue") * 5).alias("cap"))
    return ttm.join(cap, "ticker").filter("ttm > 0").select("ticker", r(F.col("cap") / F.col("ttm")).alias("live_ps"))


@query("""SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN c_name || '.DE' WHEN 1 THEN c_name || '.PA' ELSE c_name END AS symbol, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'cached') AS sector FROM customer""")
def symbol_and_enrichment(t: Tables) -> DataFrame:
    suffix = F.create_map(F.lit(0), F.lit(".DE"), F.lit(1), F.lit(".PA"))
    symbol = F.concat("c_name", F.coalesce(suffix[(F.col("c_nationkey") % 4).cast("int")], F.lit("")))
    fresh = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", symbol.alias("symbol"), F.coalesce(fresh, F.lit("cached")).alias("sector"))


@query(f"""WITH {YEARLY}, v AS (SELECT ticker, fiscal_year, revenue / 2 AS low, revenue AS mid, revenue * 2 AS high FROM yearly), a AS (SELECT *, min(low) OVER (PARTITION BY ticker) AS lo, max(high) OVER (PARTITION BY ticker) AS hi FROM v) SELECT ticker, fiscal_year, round((mid - lo) / (hi - lo), 6) AS place, round((high - low) / (hi - lo), 6) AS width FROM a""")
def football_field(t: Tables) -> DataFrame:
    v = t.yearly().select("ticker", "fiscal_year", (F.col("revenue") / 2).alias("low"), F.col("revenue").alias("mid"), (F.col("revenue") * 2).alias("high"))
    w = Window.partitionBy("ticker")
    a = v.withColumn("lo", F.min("low").over(w)).withColumn("hi", F.max("high").over(w))
    span = F.col("hi") - F.col("lo")
    return a.select("ticker", "fiscal_year", r((F.col("mid") - F.col("lo")) / span, 6).alias("place"), r((F.col("high") - F.col("low")) / span, 6).alias("width"))


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, round(CASE WHEN revenue / pow(1.09::DOUBLE, 2) > 0 THEN 1000000 / (revenue / pow(1.09::DOUBLE, 2)) END, 4) AS forward_pe FROM yearly""")
def forward_multiple(t: Tables) -> DataFrame:
    pv = valuation.present_value(F.col("revenue"), F.lit(0.09), F.lit(2))
    return t.yearly().select("ticker", "fiscal_year", r(over_positive(F.lit(1000000.0), pv)).alias("forward_pe"))


@query(f"""WITH {STATEMENTS} SELECT ticker, fiscal_year FROM statements WHERE abs(assets - (liabilities + equity)) > 100""")
def balance_check(t: Tables) -> DataFrame:
    off = F.abs(F.col("assets") - (F.col("liabilities") + F.col("equity"))) > 100
    return t.statements().filter(off).select("ticker", "fiscal_year")


@query("""SELECT CAST(l_orderkey AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 6""")
def duplicate_extra_rows(t: Tables) -> DataFrame:
    return quality.duplicates(t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"]).filter("n > 6")
