"""Choosing, cleaning and reshaping rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.nulls import growth, safe_div
from ledgerspark.operators import clean, dedup, reshape, screener, windows
from ledgerspark.queries.registry import METRICS, QUARTERLY, YEARLY, Tables, day, flat, query, r


@query(f"""WITH {YEARLY}, g AS (SELECT *, lag(revenue) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS prev, max(fiscal_year) OVER (PARTITION BY ticker) AS newest FROM yearly)
SELECT ticker, fiscal_year, revenue, round(CASE WHEN prev <> 0 THEN (revenue - prev) / abs(prev) * 100 END, 4) AS yoy_pct FROM g WHERE fiscal_year = newest AND prev IS NOT NULL""")
def latest_growth(t: Tables) -> DataFrame:
    grown = windows.yoy(t.yearly().select("ticker", "fiscal_year", "revenue"), ["ticker"], "fiscal_year", "revenue")
    return dedup.latest(grown, ["ticker"], ["fiscal_year"]).filter("yoy_pct IS NOT NULL").withColumn("yoy_pct", r("yoy_pct"))


@query("""SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filed FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY (o_orderstatus = 'F') DESC, o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""")
def latest_restatement(t: Tables) -> DataFrame:
    o = t.orders.withColumn("fiscal_year", F.year("o_orderdate").cast("long"))
    best = dedup.top_n(o, ["o_custkey", "fiscal_year"], [(F.col("o_orderstatus") == "F").desc(), F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")])
    return best.select(F.col("o_custkey").alias("ticker"), "fiscal_year", "o_orderkey", "o_totalprice", day("o_orderdate").alias("filed"))


@query("""WITH a AS (SELECT *, CAST(year(o_orderdate) + o_orderkey % 2 AS BIGINT) AS fy FROM orders), b AS (
  SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY o_custkey, fy ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey AS ticker, fy AS fiscal_year, o_orderkey FROM b QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate), o_orderstatus ORDER BY fy, o_orderkey) = 1""")
def two_stage_dedup(t: Tables) -> DataFrame:
    o = t.orders.withColumn("fiscal_year", (F.year("o_orderdate") + F.col("o_orderkey") % 2).cast("long")).withColumn("y", F.year("o_orderdate"))
    one = dedup.top_n(o, ["o_custkey", "fiscal_year"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return dedup.top_n(one, ["o_custkey", "y", "o_orderstatus"], [F.asc("fiscal_year"), F.asc("o_orderkey")]).select(F.col("o_custkey").alias("ticker"), "fiscal_year", "o_orderkey")


@query("""WITH d AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * 3 AS days, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CASE WHEN l_linenumber = 7 THEN 'snapshot' WHEN days BETWEEN 70 AND 100 THEN 'Q_standalone' WHEN days BETWEEN 160 AND 200 THEN 'YTD_6M' WHEN days BETWEEN 250 AND 290 THEN 'YTD_9M' WHEN days BETWEEN 350 AND 380 THEN 'FY_or_TTM' ELSE 'other_' || days || 'd' END AS shape, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY 1""")
def period_shape(t: Tables) -> DataFrame:
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.when(F.col("l_linenumber") != 7, F.col("o_orderdate").cast("date"))
    end = F.date_add(F.col("o_orderdate").cast("date"), F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")) * 3)
    return d.select(clean.period_shape(start, end).alias("shape")).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH a AS (SELECT o_custkey AS ticker, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS concept,
  CAST(CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 999 END AS BIGINT) AS priority FROM orders)
SELECT * FROM a QUALIFY priority = min(priority) OVER (PARTITION BY ticker, concept)""")
def synonym_priority(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), "o_orderkey", F.col("o_orderpriority").alias("concept"))
    named = clean.collapse_synonyms(o, "concept", {"1-URGENT": "HIGH", "2-HIGH": "HIGH"}, {"2-HIGH": 1, "1-URGENT": 2})
    return clean.first_available(named, ["ticker", "concept"], "priority").select("ticker", "o_orderkey", "concept", "priority")


@query("""WITH f AS (SELECT o_custkey AS ticker, o_orderstatus AS concept, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, CAST(o_orderdate AS DATE) AS period_end, o_orderkey AS value, o_totalprice,
  CAST(o_orderkey % 3 AS BIGINT) AS priority, CASE WHEN o_orderkey % 2 = 0 THEN 'FY_or_TTM' ELSE 'other' END AS shape FROM orders), g AS (SELECT * REPLACE (fiscal_year + value % 3 - 1 AS fiscal_year) FROM f),
one AS (SELECT * FROM g WHERE year(period_end) >= fiscal_year QUALIFY row_number() OVER (PARTITION BY ticker, concept, fiscal_year ORDER BY (shape = 'FY_or_TTM') DESC, period_end DESC, period_end DESC, priority, value DESC) = 1)
SELECT ticker, concept, fiscal_year, value FROM one QUALIFY row_number() OVER (PARTITION BY ticker, concept, period_end ORDER BY fiscal_year, value DESC) = 1""")
def fiscal_year_choice(t: Tables) -> DataFrame:
    end = F.col("o_orderdate").cast("date")
    f = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("concept"), (F.year("o_orderdate") + F.col("o_orderkey") % 3 - 1).cast("long").alias("fiscal_year"), end.alias("period_end"), end.alias("filed"), F.col("o_orderkey").alias("value"), (F.col("o_orderkey") % 3).alias("priority"), F.when(F.col("o_orderkey") % 2 == 0, "FY_or_TTM").otherwise("other").alias("period_shape"))
    return clean.choose_fiscal_year(f, ["ticker", "concept"]).select("ticker", "concept", "fiscal_year", "value")


_YTD = QUARTERLY + """, cum AS (SELECT *, sum(revenue) OVER (PARTITION BY ticker, fiscal_year ORDER BY quarter) AS ytd, count(*) OVER (PARTITION BY ticker, fiscal_year ORDER BY quarter) AS upto FROM quarterly),
shaped AS (SELECT ticker, fiscal_year, CASE WHEN quarter = 1 THEN 'Q1' WHEN quarter = 4 THEN 'FY' ELSE 'YTD' || quarter END AS shape, ytd AS value FROM cum WHERE upto = quarter
  UNION ALL SELECT ticker, fiscal_year, 'Q' || quarter, revenue FROM quarterly WHERE quarter > 1 AND (ticker + quarter) % 5 = 0)"""


def _ytd(t: Tables) -> DataFrame:
    q = t.quarterly()
    w = Window.partitionBy("ticker", "fiscal_year").orderBy("quarter")
    cum = q.withColumn("ytd", F.sum("revenue").over(w)).withColumn("upto", F.count(F.lit(1)).over(w)).filter("upto = quarter")
    shape = F.when(F.col("quarter") == 1, "Q1").when(F.col("quarter") == 4, "FY").otherwise(F.concat(F.lit("YTD"), F.col("quarter").cast("string")))
    alone = q.filter("quarter > 1 AND (ticker + quarter) % 5 = 0").select("ticker", "fiscal_year", F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("shape"), F.col("revenue").alias("value"))
    return cum.select("ticker", "fiscal_year", shape.alias("shape"), F.col("ytd").alias("value")).unionByName(alone)


@query(f"""WITH {_YTD}, w AS (SELECT ticker, fiscal_year, bool_or(ticker % 4 <> 0) AS add_, max(CASE WHEN shape = 'Q1' THEN value END) AS q1, max(CASE WHEN shape = 'Q2' THEN value END) AS q2, max(CASE WHEN shape = 'Q3' THEN value END) AS q3, max(CASE WHEN shape = 'Q4' THEN value END) AS q4,
  max(CASE WHEN shape = 'YTD2' THEN value END) AS y2, max(CASE WHEN shape = 'YTD3' THEN value END) AS y3, max(CASE WHEN shape = 'FY' THEN value END) AS fy FROM shaped GROUP BY 1, 2)
SELECT ticker, fiscal_year, round(q1, 2) AS q1, round(coalesce(q2, CASE WHEN add_ THEN y2 - q1 END), 2) AS q2, round(coalesce(q3, CASE WHEN add_ THEN y3 - y2 END), 2) AS q3, round(coalesce(q4, CASE WHEN add_ THEN fy - y3 END), 2) AS q4 FROM w""")
def ytd_to_standalone(t: Tables) -> DataFrame:
    q = clean.derive_quarters(_ytd(t), ["ticker", "fiscal_year"], F.col("ticker") % 4 != 0)
    return q.select("ticker", "fiscal_year", *[r(f"q{k}", 2).alias(f"q{k}") for k in range(1, 5)])


@query(f"""WITH {_YTD}, a AS (SELECT ticker, fiscal_year, max(CASE WHEN shape = 'YTD2' THEN value END) - max(CASE WHEN shape = 'Q1' THEN value END) AS derived, max(CASE WHEN shape = 'Q2' THEN value END) AS reported FROM shaped GROUP BY 1, 2)
SELECT ticker, fiscal_year, round(reported, 2) AS reported, round(derived, 2) AS derived, CASE WHEN abs(derived - reported) < 1e-6 THEN 0.0::DOUBLE ELSE round((derived - reported) / abs(reported) * 100, 4) END AS diff_pct FROM a WHERE derived IS NOT NULL AND reported IS NOT NULL""")
def quarter_cross_check(t: Tables) -> DataFrame:
    v = lambda s: F.max(F.when(F.col("shape") == s, F.col("value")))
    a = _ytd(t).groupBy("ticker", "fiscal_year").agg((v("YTD2") - v("Q1")).alias("derived"), v("Q2").alias("reported")).filter("derived IS NOT NULL AND reported IS NOT NULL")
    return a.select("ticker", "fiscal_year", r("reported", 2).alias("reported"), r("derived", 2).alias("derived"), r(growth(F.col("reported") + flat(F.col("derived") - F.col("reported")), F.col("reported"))).alias("diff_pct"))


@query(f"""WITH {QUARTERLY}, p AS (SELECT ticker, fiscal_year, 'Q' || quarter AS period, revenue FROM quarterly UNION ALL SELECT ticker, fiscal_year, 'FY', sum(revenue) FROM quarterly WHERE ticker % 3 = 0 GROUP BY 1, 2),
w AS (SELECT ticker, fiscal_year, max(CASE WHEN period = 'FY' THEN revenue END) AS fy, count(CASE WHEN period <> 'FY' THEN 1 END) AS n, sum(CASE WHEN period <> 'FY' THEN revenue END) AS total FROM p GROUP BY 1, 2)
SELECT ticker, fiscal_year, round(coalesce(fy, CASE WHEN n = 4 THEN total END), 2) AS revenue, fy IS NULL AS is_derived FROM w WHERE fy IS NOT NULL OR n = 4""")
def fy_from_quarters(t: Tables) -> DataFrame:
    q = t.quarterly()
    fy = q.filter("ticker % 3 = 0").groupBy("ticker", "fiscal_year").agg(F.sum("revenue").alias("revenue")).withColumn("period", F.lit("FY"))
    rows = q.withColumn("period", F.concat(F.lit("Q"), F.col("quarter").cast("string"))).drop("quarter").unionByName(fy)
    return clean.year_from_quarters(rows, ["ticker", "fiscal_year"], "period", "revenue").withColumn("revenue", r("revenue", 2))


@query("""SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, CAST(coalesce(max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END), sum(CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderkey END)) AS BIGINT) AS value FROM orders GROUP BY 1, 2""")
def aggregate_else_sum(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fiscal_year"), "o_orderstatus", F.col("o_orderkey").alias("value"))
    return clean.aggregate_else_sum(o, ["ticker", "fiscal_year"], "o_orderstatus", "value", "O", ["F", "P"])


@query("""WITH a AS (SELECT o_custkey AS ticker, o_orderkey, o_orderkey % 3 AS priority, o_orderstatus = 'F' AS annual FROM orders)
SELECT ticker, o_orderkey FROM a QUALIFY priority = coalesce(min(CASE WHEN annual THEN priority END) OVER (PARTITION BY ticker), min(priority) OVER (PARTITION BY ticker))""")
def tag_pin(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), "o_orderkey", (F.col("o_orderkey") % 3).alias("priority"), "o_orderstatus")
    return clean.pin_tag(o, ["ticker"], F.col("o_orderstatus") == "F", "priority").select("ticker", "o_orderkey")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS ticker, o_orderstatus AS concept, false AS is_derived FROM orders)
SELECT * FROM a UNION ALL SELECT ticker, 'P', true FROM a WHERE concept = 'O' AND ticker NOT IN (SELECT ticker FROM a WHERE concept = 'P')""")
def fallback_concept(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("concept")).distinct().withColumn("is_derived", F.lit(False))
    return clean.fill_from(a, ["ticker"], "concept", "O", "P")


@query("""SELECT DISTINCT c_custkey AS ticker, 'none' AS reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey IS NOT NULL)""")
def orphan_keys(t: Tables) -> DataFrame:
    return clean.orphans(t.customer.select(F.col("c_custkey").alias("ticker")), t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("ticker")), ["ticker"]).withColumn("reason", F.lit("none"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS ticker, o_orderstatus AS stmt FROM orders), s AS (SELECT DISTINCT o_custkey AS ticker, o_orderstatus AS stmt FROM orders WHERE o_orderkey % 2 = 0)
SELECT ticker, stmt FROM a WHERE (ticker, stmt) NOT IN (SELECT (ticker, stmt) FROM s) AND ticker IN (SELECT ticker FROM s)""")
def reclassified_rows(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("stmt"))
    return clean.reclassified(a.distinct(), a.filter(F.col("ticker").isNotNull()).join(t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("stmt")).distinct(), ["ticker", "stmt"], "left_semi").distinct(), ["ticker"], "stmt")


@query("""SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS DOUBLE) AS f, CAST(max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS DOUBLE) AS o, CAST(max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS DOUBLE) AS p FROM orders GROUP BY 1, 2""")
def pivot_wide(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fiscal_year"), "o_orderstatus", F.col("o_orderkey").cast("double").alias("o_orderkey"))
    return reshape.widen(o, ["ticker", "fiscal_year"], "o_orderstatus", "o_orderkey", ["F", "O", "P"])


@query(f"""WITH {YEARLY} SELECT ticker, fiscal_year, metric, value FROM (SELECT ticker, fiscal_year, 'Revenue' AS metric, revenue AS value FROM yearly UNION ALL SELECT ticker, fiscal_year, 'Orders', CAST(CASE WHEN n_orders > 1 THEN n_orders END AS DOUBLE) FROM yearly) WHERE value IS NOT NULL""")
def stack_long(t: Tables) -> DataFrame:
    y = t.yearly().withColumn("many", F.when(F.col("n_orders") > 1, F.col("n_orders")))
    return reshape.lengthen(y, ["ticker", "fiscal_year"], {"revenue": "Revenue", "many": "Orders"})


@query(f"""WITH {METRICS} SELECT ticker, max_by(value, fiscal_year) FILTER (metric = 'revenue') AS revenue, max_by(value, fiscal_year) FILTER (metric = 'orders') AS orders FROM metrics GROUP BY 1""")
def latest_pivot(t: Tables) -> DataFrame:
    return reshape.latest_each(t.metrics(), ["ticker"], "metric", "fiscal_year", "value", ["revenue", "orders"])


@query(f"""WITH {METRICS}, a AS (SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS anchor FROM metrics) SELECT ticker, fiscal_year, max(value) FILTER (metric = 'revenue') AS revenue, max(value) FILTER (metric = 'orders') AS orders FROM a WHERE fiscal_year = anchor GROUP BY 1, 2""")
def anchored_pivot(t: Tables) -> DataFrame:
    return reshape.anchored(t.metrics(), ["ticker"], "metric", "fiscal_year", "value", ["revenue", "orders"])


@query("""SELECT user_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2""")
def resample_weekly(t: Tables) -> DataFrame:
    e = reshape.resample(t.events, ["user_id"], "ts", "week", "value", "event_id")
    return e.select("user_id", day("period").alias("week"), "value")


@query("""WITH p AS (SELECT o_custkey AS ticker, o_orderstatus AS part, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS value FROM orders GROUP BY 1, 2), tot AS (SELECT ticker, sum(value) AS total FROM p GROUP BY 1),
shown AS (SELECT p.*, total FROM p JOIN tot USING (ticker) WHERE part <> 'P')
SELECT ticker, part, round(value, 2) AS value FROM shown UNION ALL SELECT ticker, 'other', round(max(total) - sum(value), 2) FROM shown GROUP BY ticker HAVING max(total) - sum(value) > max(total) * 0.01""")
def composition_other(t: Tables) -> DataFrame:
    p = t.orders.groupBy(F.col("o_custkey").alias("ticker"), F.col("o_orderstatus").alias("part")).agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 100.0).alias("value"))
    total = p.withColumn("total", F.sum("value").over(Window.partitionBy("ticker"))).filter("part <> 'P'")
    return reshape.with_remainder(total, ["ticker"], "part", "value", "total").withColumn("value", r("value", 2))


@query(f"""WITH {YEARLY}, l AS (SELECT 'DCF' || CASE ticker % 3 WHEN 0 THEN ' — Bull' WHEN 1 THEN ' — Bear' ELSE '' END AS label, revenue FROM yearly)
SELECT regexp_replace(label, ' — [^—]+$', '') AS base, CASE WHEN label LIKE '% — %' THEN regexp_extract(label, ' — ([^—]+)$', 1) END AS scenario, CAST(count(*) AS BIGINT) AS n FROM l GROUP BY 1, 2""")
def scenario_labels(t: Tables) -> DataFrame:
    label = F.concat(F.lit("DCF"), F.when(F.col("ticker") % 3 == 0, " — Bull").when(F.col("ticker") % 3 == 1, " — Bear").otherwise(""))
    base, scenario = reshape.parse_suffix(F.col("label"))
    return t.yearly().withColumn("label", label).groupBy(base.alias("base"), scenario.alias("scenario")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS ticker, o_orderkey FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) <= 2""")
def retention_dense_rank(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), "o_orderkey", F.year("o_orderdate").alias("y"))
    return dedup.retain_recent(o, ["ticker"], "y", 2).drop("y")


@query("""SELECT o.o_custkey AS ticker, o_orderkey FROM orders o JOIN (SELECT o_custkey, d FROM (SELECT o_custkey, d, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC) AS rn FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)) WHERE rn <= 3) k ON o.o_custkey = k.o_custkey AND CAST(o.o_orderdate AS DATE) = k.d""")
def slot_prune(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("ticker"), "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return dedup.prune_slots(o, ["ticker"], "d", 3).select("ticker", "o_orderkey")


@query("""WITH c AS (SELECT * FROM orders WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1)
SELECT o_orderkey, o_custkey AS ticker FROM c UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'O'""")
def partition_rejoin(t: Tables) -> DataFrame:
    o = t.orders.withColumn("d", F.col("o_orderdate").cast("date"))
    return dedup.rejoin(o, F.col("o_orderstatus") == "O", ["o_custkey", "d"], [F.desc("o_orderkey")]).select("o_orderkey", F.col("o_custkey").alias("ticker"))


@query("""WITH a AS (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS x, CASE WHEN value > 20 THEN value END AS y FROM events)
SELECT user_id, event_id FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (x IS NOT NULL)::INT + (y IS NOT NULL)::INT DESC, event_id) = 1""")
def most_complete(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("x"), F.when(F.col("value") > 20, F.col("value")).alias("y"))
    return dedup.keep_most_complete(e, ["user_id"], ["x", "y"], [F.asc("event_id")]).select("user_id", "event_id")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25 OFFSET 50""")
def page_of_orders(t: Tables) -> DataFrame:
    return screener.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")], 2, 25)


@query("""SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, round(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / nullif(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS DOUBLE), 0), 4) AS per_unit, CAST(count(*) FILTER (l_linestatus = 'O') AS BIGINT) AS open, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers FROM lineitem GROUP BY 1 HAVING count(*) > 10""")
def conditional_aggregates(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy(F.col("l_linenumber").cast("long").alias("l_linenumber")).agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).cast("double").alias("a"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long"))).cast("double").alias("b"), F.count_if(F.col("l_linestatus") == "O").alias("open"), F.count_distinct("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("n"))
    return g.filter("n > 10").select("l_linenumber", r(safe_div("a", "b")).alias("per_unit"), "open", "suppliers")
