"""As-of, range and offset joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators import asof as op
from ledgerspark.operators.windows import nearest
from ledgerspark.queries.registry import BRAND_YEARS, YEARLY, Tables, day, query, r


def _targets(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")


def _quotes(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'view'").groupBy("user_id", F.col("ts").alias("quote_ts")).agg(F.max("value").alias("price"))


_TQ = """t AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id, ts AS quote_ts, max(value) AS price FROM events WHERE event_type = 'view' GROUP BY 1, 2)"""


@query(f"""WITH {_TQ} SELECT event_id, t.user_id, price FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts >= q.quote_ts""")
def asof_price(t: Tables) -> DataFrame:
    return op.asof(_targets(t), _quotes(t), ["user_id"], "ts", "quote_ts", ["price"]).select("event_id", "user_id", "price")


@query(f"""WITH {_TQ} SELECT event_id, price FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts >= q.quote_ts""")
def asof_aggregate(t: Tables) -> DataFrame:
    return op.asof_few(_targets(t), _quotes(t), ["user_id"], ["event_id"], "ts", "quote_ts", ["price"]).select("event_id", "price")


@query(f"""WITH {_TQ} SELECT event_id, CASE WHEN date_diff('day', CAST(quote_ts AS DATE), CAST(ts AS DATE)) <= 2 THEN price END AS price FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts >= q.quote_ts""")
def asof_tolerance(t: Tables) -> DataFrame:
    return op.asof(_targets(t), _quotes(t), ["user_id"], "ts", "quote_ts", ["price"], tolerance_days=2).select("event_id", "price")


@query(f"""WITH {_TQ}, l AS (SELECT user_id, arg_max(price, quote_ts) AS last_price FROM q GROUP BY 1)
SELECT event_id, coalesce(price, last_price) AS price FROM (SELECT event_id, t.user_id, price FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts >= q.quote_ts) a LEFT JOIN l USING (user_id)""")
def asof_fallback(t: Tables) -> DataFrame:
    q = _quotes(t)
    newest = q.groupBy("user_id").agg(F.max_by("price", "quote_ts").alias("last_price"))
    found = op.asof(_targets(t), q, ["user_id"], "ts", "quote_ts", ["price"])
    return op.with_fallback(found, "price", newest, ["user_id"], "last_price").select("event_id", "price")


@query("""WITH t AS (SELECT event_id, ts, value, CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS base, 'USD' AS quote FROM events WHERE event_type = 'purchase'),
f AS (SELECT CASE user_id % 3 WHEN 1 THEN 'EUR' ELSE 'CHF' END AS base, 'USD' AS quote, ts AS rate_ts, max(1 + value / 1000) AS rate FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3)
SELECT event_id, t.base, round(CASE WHEN t.base = t.quote THEN value ELSE value * rate END, 8) AS usd, t.base <> t.quote AND rate IS NULL AS missing FROM t ASOF LEFT JOIN f ON t.base = f.base AND t.quote = f.quote AND t.ts >= f.rate_ts""")
def fx_asof_left(t: Tables) -> DataFrame:
    m = F.col("user_id") % 3
    rows = t.events.filter("event_type = 'purchase'").select("event_id", "ts", "value", F.when(m == 0, "USD").when(m == 1, "EUR").otherwise("GBP").alias("base"), F.lit("USD").alias("quote"))
    rates = t.events.filter("event_type = 'view'").groupBy(F.when(m == 1, "EUR").otherwise("CHF").alias("base"), F.lit("USD").alias("quote"), F.col("ts").alias("rate_ts")).agg(F.max(1 + F.col("value") / 1000).alias("rate"))
    found = op.asof(rows, rates, ["base", "quote"], "ts", "rate_ts", ["rate"])
    same = F.col("base") == F.col("quote")
    return found.select("event_id", "base", r(F.when(same, F.col("value")).otherwise(F.col("value") * F.col("rate")), 8).alias("usd"), (~same & F.col("rate").isNull()).alias("missing"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fy, CAST(make_date(CAST(year(o_orderdate) AS INT), 6, 30) AS TIMESTAMP) AS anchor FROM orders),
j AS (SELECT o.o_orderkey, o.o_custkey AS ticker, o.o_orderdate, a.fy, a.anchor, date_diff('day', CAST(a.anchor AS DATE), CAST(o.o_orderdate AS DATE)) AS days FROM orders o ASOF LEFT JOIN a ON o.o_custkey = a.ticker AND o.o_orderdate >= a.anchor),
b AS (SELECT *, CASE WHEN days BETWEEN 1 AND 400 THEN fy + 1 END AS fiscal_year FROM j)
SELECT o_orderkey, ticker, CAST(fiscal_year AS DOUBLE) AS fiscal_year, CASE WHEN fiscal_year IS NOT NULL THEN 'Q' || row_number() OVER (PARTITION BY ticker, fiscal_year ORDER BY o_orderdate, o_orderkey) END AS label FROM b""")
def filing_brackets(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    anchors = t.orders.select(F.col("o_custkey").alias("ticker"), year.cast("long").alias("fy"), F.make_date(year, F.lit(6), F.lit(30)).cast("timestamp_ntz").alias("anchor")).distinct()
    found = op.asof(t.orders.select("o_orderkey", F.col("o_custkey").alias("ticker"), "o_orderdate"), anchors, ["ticker"], "o_orderdate", "anchor", ["fy"])
    days = F.datediff(F.col("o_orderdate").cast("date"), F.col("anchor").cast("date"))
    labelled = found.withColumn("fiscal_year", F.when(days.between(1, 400), F.col("fy") + 1))
    rank = F.row_number().over(Window.partitionBy("ticker", "fiscal_year").orderBy("o_orderdate", "o_orderkey"))
    return labelled.select("o_orderkey", "ticker", F.col("fiscal_year").cast("double").alias("fiscal_year"), F.when(F.col("fiscal_year").isNotNull(), F.concat(F.lit("Q"), rank.cast("string"))).alias("label"))


@query("""WITH e AS (SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fy, max(CAST(o_orderdate AS DATE)) AS closed FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2)
SELECT o_orderkey, CAST(min(fy) AS DOUBLE) AS implied FROM orders o LEFT JOIN e ON o.o_custkey = e.ticker AND e.closed >= CAST(o.o_orderdate AS DATE) GROUP BY 1""")
def implied_year(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("ticker"), F.col("o_orderdate").cast("date").alias("d"))
    ends = t.orders.filter("o_orderkey % 3 <> 0").groupBy(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fy")).agg(F.max(F.col("o_orderdate").cast("date")).alias("closed"))
    return op.implied_period(o, ends, ["ticker"], "d", "closed", "fy").select("o_orderkey", F.col("implied").cast("double").alias("implied"))


@query(f"""WITH {YEARLY}, j AS (SELECT a.ticker, a.fiscal_year, a.revenue, b.fiscal_year AS base_year, b.revenue AS base, row_number() OVER (PARTITION BY a.ticker, a.fiscal_year ORDER BY b.fiscal_year) AS rn FROM yearly a JOIN yearly b ON a.ticker = b.ticker AND b.fiscal_year BETWEEN a.fiscal_year - 5 AND a.fiscal_year - 3 AND b.revenue > 0)
SELECT ticker, fiscal_year, base_year, round((pow(revenue / base, 1.0::DOUBLE / (fiscal_year - base_year)) - 1) * 100, 4) AS cagr_pct FROM j WHERE rn = 1""")
def cagr_earliest_base(t: Tables) -> DataFrame:
    b = op.earliest_base(t.yearly(), ["ticker"], "fiscal_year", "revenue").filter("base_year IS NOT NULL")
    cagr = (F.pow(F.col("revenue") / F.col("base_value"), 1.0 / (F.col("fiscal_year") - F.col("base_year"))) - 1) * 100
    return b.select("ticker", "fiscal_year", "base_year", r(cagr).alias("cagr_pct"))


@query(f"""WITH {YEARLY} SELECT a.ticker, a.fiscal_year, b.revenue AS revenue_3y_ago, c.revenue AS next_revenue FROM yearly a LEFT JOIN yearly b ON a.ticker = b.ticker AND b.fiscal_year = a.fiscal_year - 3 LEFT JOIN yearly c ON a.ticker = c.ticker AND c.fiscal_year = a.fiscal_year + 1""")
def exact_offset(t: Tables) -> DataFrame:
    y = op.at_offset(t.yearly(), ["ticker"], "fiscal_year", "revenue", -3, "revenue_3y_ago")
    return op.at_offset(y, ["ticker"], "fiscal_year", "revenue", 1, "next_revenue").select("ticker", "fiscal_year", "revenue_3y_ago", "next_revenue")


@query(f"""WITH {BRAND_YEARS}, s AS (SELECT DISTINCT p_brand AS brand, CAST(l_shipdate AS DATE) AS split_date, 1 + CAST(l_linenumber AS DOUBLE) / 10 AS ratio FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity = 50 AND l_discount = 0.05 AND l_linenumber IN (1, 2)),
e AS (SELECT brand, fiscal_year, make_date(CAST(fiscal_year AS INT), 12, 31) AS period_end FROM brand_years)
SELECT e.brand, fiscal_year, round(coalesce(exp(sum(ln(ratio))), 1.0::DOUBLE), 4) AS factor FROM e LEFT JOIN s ON e.brand = s.brand AND s.split_date > e.period_end GROUP BY 1, 2""")
def split_factor(t: Tables) -> DataFrame:
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).filter("l_quantity = 50 AND l_discount = 0.05 AND l_linenumber IN (1, 2)")
    splits = sold.select(F.col("p_brand").alias("brand"), F.col("l_shipdate").cast("date").alias("split_date"), (1 + F.col("l_linenumber").cast("double") / 10).alias("ratio")).distinct()
    ends = t.brand_years().select("brand", "fiscal_year", F.make_date(F.col("fiscal_year").cast("int"), F.lit(12), F.lit(31)).alias("period_end"))
    return op.factor_after(ends, splits, ["brand"], ["brand", "fiscal_year"], "period_end", "split_date", "ratio").select("brand", "fiscal_year", r("factor").alias("factor"))


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
  first_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM events""")
def nearest_neighbour(t: Tables) -> DataFrame:
    e = t.events.withColumn("o", F.struct("ts", "event_id"))
    earlier, later = nearest(F.when(F.col("event_type") == "view", F.col("value")), ["user_id"], "o")
    return e.select("user_id", "event_id", earlier.alias("earlier"), later.alias("later"))


@query("""WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'), b AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error')
SELECT user_id, CAST(d AS VARCHAR) AS d, EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND abs(date_diff('day', a.d, b.d)) <= 3) AS matched FROM a""")
def tolerance_match(t: Tables) -> DataFrame:
    days = lambda kind, name: t.events.filter(F.col("event_type") == kind).select("user_id", F.col("ts").cast("date").alias(name)).distinct()
    found = op.within(days("signup", "d"), days("error", "e"), ["user_id"], F.abs(F.datediff("d", "e")) <= 3)
    return found.select("user_id", F.col("d").cast("string").alias("d"), "matched")


@query("""SELECT coalesce(c, s) AS nation, c IS NOT NULL AS in_customers, s IS NOT NULL AS in_suppliers FROM (SELECT DISTINCT c_nationkey AS c FROM customer WHERE c_nationkey % 3 <> 0) FULL JOIN (SELECT DISTINCT s_nationkey AS s FROM supplier WHERE s_nationkey % 2 = 0) ON c = s""")
def full_outer_merge(t: Tables) -> DataFrame:
    c = t.customer.filter("c_nationkey % 3 <> 0").select(F.col("c_nationkey").alias("c")).distinct()
    s = t.supplier.filter("s_nationkey % 2 = 0").select(F.col("s_nationkey").alias("s")).distinct()
    return c.join(s, F.col("c") == F.col("s"), "full_outer").select(F.coalesce("c", "s").alias("nation"), F.col("c").isNotNull().alias("in_customers"), F.col("s").isNotNull().alias("in_suppliers"))


@query("""SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'P') AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o_orderdate) = 1998)""")
def semi_and_anti(t: Tables) -> DataFrame:
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    c = t.customer.join(o.filter("o_orderstatus = 'P'"), "c_custkey", "left_semi").join(t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey", "left_semi")
    return c.join(o.filter(F.year("o_orderdate") == 1998), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("""SELECT c_custkey, n_name, coalesce(r_name, 'unknown') AS section, CAST(row_number() OVER (PARTITION BY r_name, n_name ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS place FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey""")
def hierarchy_enrichment(t: Tables) -> DataFrame:
    dims = t.nation.join(t.region.filter("r_regionkey <> 2"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    c = t.customer.join(dims, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    place = F.row_number().over(Window.partitionBy("r_name", "n_name").orderBy(F.desc("c_acctbal"), "c_custkey")).cast("long")
    return c.select("c_custkey", "n_name", F.coalesce("r_name", F.lit("unknown")).alias("section"), place.alias("place"))


@query("""SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS last_order, CAST(count(*) AS BIGINT) AS n FROM (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1) GROUP BY 1""")
def latest_per_key(t: Tables) -> DataFrame:
    newest = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    return newest.groupBy(day("d").alias("last_order")).agg(F.count(F.lit(1)).alias("n"))
