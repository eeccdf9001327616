"""Currency, plausibility, checks, read-model pieces, ingestion shapes and model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import asof, checks, clean, forecast, identity, metrics, plausibility, reshape, screener, statements, upsert, valuation
from ledgerspark.operators.quality import contract_errors, severity
from ledgerspark.queries.registry import METRICS, STATEMENTS, YEARLY, Tables, query, r
from ledgerspark.sources import ingest


def _amounts(t: Tables) -> DataFrame:
    m = F.col("o_orderkey") % 3
    return t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("value"), F.when(m == 0, "USD").when(m == 1, "EUR").otherwise("XXX").alias("currency"))


@query("""SELECT o_orderkey, round(CASE o_orderkey % 3 WHEN 1 THEN o_totalprice * 1.25::DOUBLE ELSE o_totalprice END, 4) AS value, CASE o_orderkey % 3 WHEN 2 THEN 'XXX' ELSE 'USD' END AS currency, o_orderkey % 3 <> 2 AS converted FROM orders""")
def currency_conversion(t: Tables) -> DataFrame:
    rated = _amounts(t).drop("d").withColumn("rate", F.when(F.col("currency") == "EUR", 1.25))
    done, rejected = plausibility.split_convertible(rated, "value", "currency", "USD", "rate")
    return done.withColumn("converted", F.lit(True)).unionByName(rejected.withColumn("converted", F.lit(False))).select("o_orderkey", r("value").alias("value"), "currency", "converted")


@query("""WITH rates AS (SELECT DISTINCT 'EUR' AS base, CAST(date_trunc('month', l_shipdate) AS DATE) AS rd, 1 + month(l_shipdate) / 100.0::DOUBLE AS rate FROM lineitem WHERE year(l_shipdate) >= 1996),
a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS value, CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'XXX' END AS currency FROM orders)
SELECT o_orderkey, round(CASE WHEN currency <> 'USD' AND rate IS NOT NULL THEN value * rate ELSE value END, 4) AS value, CASE WHEN rate IS NOT NULL THEN 'USD' ELSE currency END AS currency FROM a ASOF LEFT JOIN rates ON a.currency = rates.base AND a.d >= rates.rd""")
def usd_lens(t: Tables) -> DataFrame:
    months = t.lineitem.filter(F.year("l_shipdate") >= 1996).select(F.lit("EUR").alias("base"), F.date_trunc("month", "l_shipdate").cast("date").alias("rate_date"), (1 + F.month("l_shipdate") / 100.0).alias("rate")).distinct()
    return plausibility.lens(_amounts(t), months, "value", "currency", "d").select("o_orderkey", r("value").alias("value"), "currency")


_COUNTS = "counts AS (SELECT ticker, fiscal_year, make_date(fiscal_year, 12, 31) AS period_end, CASE WHEN ticker % 5 = 0 AND fiscal_year % 2 = 0 THEN n_orders * 1000 WHEN ticker % 7 = 0 THEN n_orders * 1000000000.0::DOUBLE ELSE n_orders * 1000000 END::DOUBLE AS value FROM yearly), ref AS (SELECT ticker, make_date(fiscal_year, 6, 30) AS re, n_orders * 3000000.0::DOUBLE AS rv FROM yearly WHERE fiscal_year % 3 <> 0), latest AS (SELECT ticker, arg_max(rv, re) AS lv FROM ref GROUP BY 1), judged AS (SELECT c.*, coalesce(rv, lv) AS reference, value / coalesce(rv, lv) AS ratio FROM (SELECT c.*, rv FROM counts c ASOF LEFT JOIN ref ON c.ticker = ref.ticker AND c.period_end >= ref.re) c LEFT JOIN latest USING (ticker))"


def _counts(t: Tables) -> tuple[DataFrame, DataFrame]:
    y, n = t.yearly(), F.col("n_orders")
    value = F.when((F.col("ticker") % 5 == 0) & (F.col("fiscal_year") % 2 == 0), n * 1000).when(F.col("ticker") % 7 == 0, n * 1e9).otherwise(n * 1_000_000).cast("double")
    end = lambda m, d: F.make_date(F.col("fiscal_year").cast("int"), F.lit(m), F.lit(d))
    return y.select("ticker", "fiscal_year", end(12, 31).alias("period_end"), value.alias("value")), y.filter("fiscal_year % 3 <> 0").select("ticker", end(6, 30).alias("ref_end"), (n * 3e6).alias("ref_value"))


@query(f"""WITH {YEARLY}, {_COUNTS} SELECT ticker, fiscal_year, CASE WHEN value < 100000 THEN 'floor' ELSE 'times reference' END AS reason FROM judged WHERE value < 100000 OR ratio > 100""")
def count_floor_and_ceiling(t: Tables) -> DataFrame:
    return plausibility.too_small_or_large(*_counts(t)).select("ticker", "fiscal_year", "reason")


@query(f"""WITH {YEARLY}, {_COUNTS} SELECT ticker, fiscal_year, round(ratio, 6) AS ratio FROM judged WHERE value > 0 AND ratio < 0.2 AND NOT (ticker % 2 = 0 AND abs(ratio - 0.1::DOUBLE) / ratio < 0.3) AND NOT (ticker % 10 = 0 AND abs(ratio - 0.0005::DOUBLE) / ratio < 0.3)""")
def small_unless_split(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("ticker"))
    splits = c.filter("ticker % 2 = 0").withColumn("ratio", F.lit(0.1)).unionByName(c.filter("ticker % 10 = 0").withColumn("ratio", F.lit(0.0005)))
    return plausibility.unexplained_small(*_counts(t), splits).select("ticker", "fiscal_year", r("ratio", 6).alias("ratio"))


@query(f"""WITH {YEARLY}, p AS (SELECT ticker, make_date(fiscal_year, 7, 1) AS d, n_orders * 2.5::DOUBLE AS close FROM yearly WHERE fiscal_year >= 1997), l AS (SELECT ticker, arg_max(close, d) AS last FROM p GROUP BY 1), b AS (SELECT ticker, fiscal_year, make_date(fiscal_year, 12, 31) AS pe, n_orders * 400000.0::DOUBLE AS shares, revenue * 100 AS assets FROM yearly WHERE n_orders * 400000.0::DOUBLE < 2000000 AND revenue * 100 > 20000000)
SELECT ticker, fiscal_year, round(assets / shares / coalesce(close, last), 10) AS ratio FROM (SELECT b.*, close FROM b ASOF LEFT JOIN p ON b.ticker = p.ticker AND b.pe >= p.d) x JOIN l USING (ticker) WHERE assets / shares / coalesce(close, last) > 10""")
def assets_per_share_over_price(t: Tables) -> DataFrame:
    y = t.yearly()
    shares = y.select("ticker", "fiscal_year", F.make_date(F.col("fiscal_year").cast("int"), F.lit(12), F.lit(31)).alias("period_end"), (F.col("n_orders") * 400000.0).alias("shares"))
    prices = y.filter("fiscal_year >= 1997").select("ticker", F.make_date(F.col("fiscal_year").cast("int"), F.lit(7), F.lit(1)).alias("date"), (F.col("n_orders") * 2.5).alias("close"))
    found = plausibility.over_price(shares, y.select("ticker", "fiscal_year", (F.col("revenue") * 100).alias("assets")), prices, ["ticker", "fiscal_year"])
    return found.select("ticker", "fiscal_year", r("ratio", 10).alias("ratio"))


@query("""WITH s AS (SELECT p_partkey AS ticker, DATE '1998-01-01' + CAST(p_size AS INT) AS sd, CASE p_partkey % 5 WHEN 0 THEN 0.0 ELSE 2.0 END::DOUBLE AS ratio FROM part), k AS (SELECT p_partkey AS ticker, DATE '1998-01-01' + CAST(p_size + p_partkey % 6 AS INT) AS ex, 2.0::DOUBLE AS ratio FROM part)
SELECT k.ticker, s.ratio > 0 AND abs(date_diff('day', ex, sd)) <= 3 AS found, s.ratio <= 0 AS malformed, s.ratio > 0 AND sd > DATE '1998-01-20' AS rescaled FROM k JOIN s USING (ticker)""")
def split_checks(t: Tables) -> DataFrame:
    start = F.lit("1998-01-01").cast("date")
    splits = t.part.select(F.col("p_partkey").alias("ticker"), F.date_add(start, F.col("p_size")).alias("split_date"), F.when(F.col("p_partkey") % 5 == 0, 0.0).otherwise(2.0).alias("ratio"))
    known = t.part.select(F.col("p_partkey").alias("ticker"), F.date_add(start, (F.col("p_size") + F.col("p_partkey") % 6).cast("int")).alias("ex_date"), F.lit(2.0).alias("ratio"))
    periods = t.part.select(F.col("p_partkey").alias("ticker"), F.explode(F.array(F.lit(1996), F.lit(1998))).alias("fiscal_year")).withColumn("period_end", F.when(F.col("fiscal_year") == 1998, F.lit("1998-01-20")).otherwise(F.lit("1996-01-20")).cast("date"))
    flag = lambda df, name: df.select("ticker").withColumn(name, F.lit(True))
    out = checks.known_splits(known, splits).select("ticker", "found").join(flag(checks.malformed_splits(splits), "malformed"), "ticker", "left").join(flag(checks.rescaled_latest(periods, splits), "rescaled"), "ticker", "left")
    return out.select("ticker", "found", F.coalesce("malformed", F.lit(False)).alias("malformed"), F.coalesce("rescaled", F.lit(False)).alias("rescaled"))


@query("""WITH l AS (SELECT o_custkey AS ticker, 'IS' AS stmt, 'tag' || o_orderkey % 4 AS tag, CAST(o_orderdate AS DATE) AS pe, max(o_totalprice) AS v FROM orders GROUP BY ALL), m AS (SELECT *, CASE tag WHEN 'tag0' THEN 'sales' WHEN 'tag1' THEN 'sales' WHEN 'tag2' THEN 'cost' ELSE tag END AS concept, CASE tag WHEN 'tag0' THEN 1 WHEN 'tag1' THEN 2 WHEN 'tag2' THEN 1 END AS pr FROM l),
k AS (SELECT ticker, concept, pe, CASE ticker % 4 WHEN 0 THEN max(v) * 2 WHEN 1 THEN -max(v) ELSE arg_min(v, pr) END AS kv FROM m WHERE ticker % 3 <> 0 AND pr IS NOT NULL GROUP BY ticker, concept, pe),
gap AS (SELECT ticker, concept, 'COVERAGE_GAP' AS issue FROM m WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.ticker = m.ticker AND k.concept = m.concept AND k.pe = m.pe) GROUP BY ticker, concept, pe),
best AS (SELECT * FROM m WHERE pr IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, concept, pe ORDER BY pr, abs(v) DESC) = 1),
bad AS (SELECT b.ticker, b.concept, 'VALUE_MISMATCH' AS issue FROM best b JOIN k USING (ticker, concept, pe) WHERE abs((kv - v) / v) > 0.005 AND NOT (tag = 'tag2' AND abs((kv + v) / v) <= 0.005)),
none AS (SELECT c_custkey, NULL, 'PARSE_FAIL' FROM customer WHERE c_custkey NOT IN (SELECT ticker FROM l))
SELECT ticker, concept, issue, CAST(count(*) AS BIGINT) AS n FROM (SELECT * FROM gap UNION ALL SELECT * FROM bad UNION ALL SELECT * FROM none) GROUP BY ALL""")
def presented_against_kept(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    lines = t.orders.groupBy(F.col("o_custkey").alias("ticker"), F.lit("IS").alias("stmt"), F.concat(F.lit("tag"), (F.col("o_orderkey") % 4).cast("string")).alias("tag"), day.alias("period_end")).agg(F.max("o_totalprice").alias("value")).withColumn("negated", F.col("tag") == "tag2")
    lookup = t.spark.createDataFrame([("tag0", "IS", "sales", 1), ("tag1", "IS", "sales", 2), ("tag2", "IS", "cost", 1)], "tag string, stmt string, concept string, priority int")
    m = lines.join(F.broadcast(lookup), ["tag", "stmt"]).filter("ticker % 3 <> 0")
    k = m.groupBy("ticker", "stmt", "concept", "period_end").agg(F.max("value").alias("m"), F.min_by("value", "priority").alias("b"))
    kept = k.withColumn("value", F.when(F.col("ticker") % 4 == 0, F.col("m") * 2).when(F.col("ticker") % 4 == 1, -F.col("m")).otherwise(F.col("b")))
    golden = t.customer.select(F.col("c_custkey").alias("ticker"), F.lit("IS").alias("stmt"))
    return checks.presented_against_kept(lines, lookup, kept, golden).groupBy("ticker", "concept", "issue").agg(F.count(F.lit(1)).alias("n"))


_SERIES = "series AS (SELECT CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS v FROM lineitem WHERE day(l_shipdate) = 1 AND year(l_shipdate) >= 1996 GROUP BY 1), o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS e, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) + 200 END AS x FROM orders), b AS (SELECT o.*, (SELECT arg_max(v, d) FROM series WHERE d <= x) / (SELECT arg_max(v, d) FROM series WHERE d <= e) - 1 AS ret FROM o)"


def _priced(t: Tables) -> DataFrame:
    e = F.col("o_orderdate").cast("date")
    o = t.orders.select("o_orderkey", "o_custkey", e.alias("entry_date"), F.when(F.col("o_orderkey") % 6 != 0, F.date_add(e, 200)).alias("exit_date"))
    series = t.lineitem.filter((F.dayofmonth("l_shipdate") == 1) & (F.year("l_shipdate") >= 1996)).groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.max("l_extendedprice").alias("v"))
    return asof.benchmark_return(o, "entry_date", "exit_date", series, "d", "v")


@query(f"""WITH {_SERIES} SELECT o_orderkey, round(ret, 6) AS benchmark_return FROM b""")
def benchmark_leg(t: Tables) -> DataFrame:
    return _priced(t).select("o_orderkey", r("benchmark_return", 6).alias("benchmark_return"))


@query(f"""WITH {_SERIES} SELECT CAST(o_custkey % 10 AS BIGINT) AS archetype, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (o_orderkey % 9 = 0) AS BIGINT) AS look_ahead, CAST(0 AS BIGINT) AS exit_before_entry, CAST(count(x) AS BIGINT) AS with_exit, round(count(*) FILTER (x IS NOT NULL AND ret IS NULL) / CAST(count(x) AS DOUBLE), 6) AS benchmark_missing FROM b GROUP BY 1""")
def backtest_bias(t: Tables) -> DataFrame:
    rows = _priced(t).withColumn("archetype", F.col("o_custkey") % 10).withColumn("as_of", F.when(F.col("o_orderkey") % 9 == 0, F.date_sub("entry_date", 1)).otherwise(F.col("entry_date"))).withColumn("holding_return", F.when(F.col("exit_date").isNotNull(), 0.1))
    return checks.bias_report(rows, "archetype").withColumn("benchmark_missing", r("benchmark_missing", 6))


@query("""SELECT c_custkey AS ticker, CASE WHEN c_custkey % 4 = 0 THEN 'excluded' WHEN c_custkey % 4 = 1 THEN 'excluded' WHEN c_custkey % 5 = 0 THEN 'dual listed' ELSE 'admitted' END AS status, CASE c_custkey % 4 WHEN 0 THEN 'no entry' WHEN 1 THEN 'ambiguous' END AS reason FROM customer""")
def admission_chain(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    ticker = k.cast("string")
    candidates = t.customer.select(ticker.alias("ticker"), F.concat(F.lit("Maple Group "), F.col("c_name"), F.lit(" Inc.")).alias("company"))
    registry = t.customer.filter(k % 4 != 0).select(ticker.alias("ticker"), F.when(k % 4 == 1, "Maple Gaming Corp").otherwise(F.concat(F.lit("MAPLE GROUP "), F.upper("c_name"))).alias("title"))
    found = identity.admit(candidates, registry, t.customer.filter(k % 5 == 0).select(ticker.alias("ticker")))
    return found.select(F.col("ticker").cast("long").alias("ticker"), "status", "reason")


@query("""SELECT s_suppkey AS ticker FROM supplier WHERE s_suppkey % 3 = 0""")
def market_collisions(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("ticker"), F.lit(None).cast("string").alias("market"), F.concat(F.lit("Northern "), F.col("s_name")).alias("company"))
    ca = s.select("ticker", F.lit("CA").alias("market"), F.when(F.col("ticker") % 3 == 0, F.lit("Southern Mining Ltd")).when(F.col("ticker") % 3 == 1, F.concat("company", F.lit(" Inc"))).alias("company")).filter("ticker % 3 < 2")
    return identity.market_collisions(s.unionByName(ca).unionByName(s)).select("ticker")


@query("""SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1""")
def nearest_rank_percentiles(t: Tables) -> DataFrame:
    return statements.percentiles(t.events, ["event_type"], "value")


@query(f"""WITH {YEARLY} SELECT ticker, CAST(count(*) AS BIGINT) AS n_rows, min(fiscal_year) AS first, max(fiscal_year) AS last FROM yearly GROUP BY 1""")
def range_manifest(t: Tables) -> DataFrame:
    return statements.manifest(t.yearly(), ["ticker"], "fiscal_year")


@query("""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_keys, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest, CAST(date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '2002-01-01') AS BIGINT) AS age_days FROM orders""")
def table_snapshot(t: Tables) -> DataFrame:
    s = statements.snapshot(t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("d")), "o_custkey", "d", F.lit("2002-01-01").cast("date"))
    return s.select("n_rows", "n_keys", F.col("latest").cast("string").alias("latest"), F.col("age_days").cast("long").alias("age_days"))


@query(f"""WITH {METRICS}, n AS (SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS newest FROM metrics), l AS (SELECT * FROM n WHERE fiscal_year = newest) SELECT l.ticker, l.metric, round(l.value / w.value * 100, 4) AS pct FROM l JOIN l w ON l.ticker = w.ticker AND w.metric = 'revenue'""")
def waterfall(t: Tables) -> DataFrame:
    return statements.shares_of(t.metrics(), ["ticker"], "metric", "fiscal_year", "value", "revenue").select("ticker", "metric", r("pct").alias("pct"))


@query("""WITH g AS (SELECT user_id, event_type, count(*) AS n, max(CAST(ts AS DATE)) AS last FROM events WHERE event_type IN ('view', 'click', 'error', 'signup') GROUP BY 1, 2) SELECT user_id, event_type AS name, CAST(n AS BIGINT) AS n, CAST(last AS VARCHAR) AS last FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, last DESC, event_type) <= 3""")
def parallel_arrays(t: Tables) -> DataFrame:
    arrays = t.events.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type", F.col("ts").cast("date").alias("d")))).alias("e"))
    arrays = arrays.select("user_id", F.col("e.event_type").alias("names"), F.col("e.d").alias("dates"))
    return statements.events_like(arrays, "user_id", "names", "dates", ["View", "click", "error", "signup"]).withColumn("last", F.col("last").cast("string"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'grand-total' WHEN 1 THEN 'headline' WHEN 2 THEN 'subtotal' WHEN 3 THEN 'subtotal' ELSE '' END AS row_class, CAST(CASE WHEN o_orderkey % 5 = 4 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS indent FROM orders""")
def statement_layout(t: Tables) -> DataFrame:
    m = F.col("o_orderkey") % 5
    o = t.orders.select("o_orderkey", F.lit("BS").alias("stmt"), F.concat(F.lit("c"), m.cast("string")).alias("concept"), F.when(m == 3, "Total things").otherwise("Things").alias("label"), F.when(F.col("o_orderkey") % 2 == 0, "Current").otherwise("Assets").alias("group"))
    cls = statements.row_class(F.col("stmt"), F.col("concept"), F.col("label"), ["c0"], [("BS", "c1")], ["c2"])
    return o.withColumn("row_class", cls).select("o_orderkey", "row_class", statements.indent(F.lit("Assets"), F.col("group"), F.col("row_class")).cast("long").alias("indent"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'limit' WHEN 2 THEN 'other' END AS category FROM events""")
def error_categories(t: Tables) -> DataFrame:
    m = F.col("event_id") % 4
    message = F.when(m == 0, "HTTP 404 Not Found").when(m == 1, "too many Requests (429)").when(m == 2, "boom")
    return t.events.select("event_id", statements.error_category(message, {"404|not found": "missing", "429|too many": "limit"}).alias("category"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS p, o_orderstatus FROM orders), u AS (SELECT o_orderstatus, min(o_orderpriority) AS unit FROM orders GROUP BY 1) SELECT o_orderkey, max(p) OVER (PARTITION BY o_custkey) AS company, unit FROM o JOIN u USING (o_orderstatus)""")
def fill_and_unit(t: Tables) -> DataFrame:
    o = t.orders.withColumn("p", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority"))).withColumn("company", statements.filled("p", ["o_custkey"]))
    unit = statements.units(t.orders, "o_orderstatus", "o_orderpriority").withColumnRenamed("o_orderpriority", "unit")
    return o.join(unit, "o_orderstatus").select("o_orderkey", "company", "unit")


_LABELS = "d AS (SELECT o_custkey AS k, o_orderstatus AS stmt, o_orderkey FROM orders), s AS (SELECT DISTINCT k, stmt FROM d WHERE o_orderkey % 3 = 0)"


@query(f"""WITH {_LABELS} SELECT k, stmt, o_orderkey FROM d WHERE EXISTS (SELECT 1 FROM s WHERE s.k = d.k AND s.stmt = d.stmt) OR NOT EXISTS (SELECT 1 FROM s WHERE s.k = d.k) QUALIFY row_number() OVER (PARTITION BY k, stmt ORDER BY o_orderkey DESC) = 1""")
def cross_label_collapse(t: Tables) -> DataFrame:
    d = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("stmt"), "o_orderkey")
    return clean.collapse_labels(d, d.filter("o_orderkey % 3 = 0").select("k", "stmt").distinct(), ["k"], "stmt", [F.desc("o_orderkey")])


@query("""WITH f AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) END AS d, CAST(year(o_orderdate) + o_orderkey % 3 - 1 AS BIGINT) AS fy FROM orders), u AS (SELECT DISTINCT * FROM f)
SELECT k, CAST(d AS VARCHAR) AS d, fy FROM u WHERE d IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY (fy = year(d)) DESC, fy) = 1 UNION ALL SELECT k, NULL, fy FROM u WHERE d IS NULL""")
def prefer_implied_year(t: Tables) -> DataFrame:
    d = F.when(F.col("o_orderkey") % 8 != 0, F.date_trunc("quarter", "o_orderdate").cast("date"))
    f = t.orders.select(F.col("o_custkey").alias("k"), d.alias("d"), (F.year("o_orderdate") + F.col("o_orderkey") % 3 - 1).cast("long").alias("fy")).distinct()
    years = t.customer.select(F.col("c_custkey").alias("k"), F.explode(F.sequence(F.lit(1994).cast("long"), F.lit(2003).cast("long"))).alias("fy"))
    ends = years.withColumn("e", F.make_date(F.col("fy").cast("int"), F.lit(12), F.lit(31)))
    return clean.prefer_implied(f, ends, ["k"], "d", "fy", "e").withColumn("d", F.col("d").cast("string"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'revenue' WHEN '2-HIGH' THEN 'cost' END AS canonical FROM orders""")
def mapping_decisions(t: Tables) -> DataFrame:
    rows = [("1-URGENT", "revenue", "accepted", "same meaning"), ("2-HIGH", "cost", "accepted", "checked"), ("3-MEDIUM", "assets", "ambiguous", "two meanings"), ("5-LOW", "debt", "incompatible", "other scope")]
    decisions = t.spark.createDataFrame(rows, "source_concept string, canonical_concept string, status string, notes string")
    return clean.apply_mapping(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("source_concept")), decisions).select("o_orderkey", "canonical")


@query("""SELECT o_orderkey FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) <= 2""")
def pruned_history(t: Tables) -> DataFrame:
    return upsert.prune_history(t.orders.withColumn("d", F.col("o_orderdate").cast("date")), ["o_custkey"], "d", 2).select("o_orderkey")


_DIMS = "d AS (SELECT o_orderkey, o_custkey AS entity, CAST(o_orderdate AS DATE) AS instant, o_orderkey % 4 AS m, o_totalprice AS value FROM orders)"


def _dims(t: Tables) -> DataFrame:
    m = F.col("o_orderkey") % 4
    member = F.concat(F.lit("M"), m.cast("string"))
    dims = F.when(m == 3, F.create_map(F.lit("class"), member, F.lit("region"), F.lit("EU"))).otherwise(F.create_map(F.lit("class"), member))
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("instant"), dims.alias("dims"), F.col("o_totalprice").alias("value"))


@query(f"""WITH {_DIMS} SELECT o_orderkey, 'M' || m AS member FROM d WHERE m IN (0, 2)""")
def allowed_members(t: Tables) -> DataFrame:
    return ingest.member_facts(_dims(t), "class", ["M0", "M2", "M3"]).select("o_orderkey", "member")


@query(f"""WITH {_DIMS}, s AS (SELECT *, max(instant) OVER (PARTITION BY entity) AS newest FROM d WHERE m < 3) SELECT entity, round(sum(value), 2) AS value FROM s WHERE instant = newest GROUP BY 1""")
def class_totals(t: Tables) -> DataFrame:
    return ingest.class_totals(_dims(t), "class").select("entity", r("value", 2).alias("value"))


@query("""SELECT n_name AS tag, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'terse ' || n_name END, CASE WHEN n_nationkey % 3 = 0 THEN 'plain ' || n_name END, n_name) AS label, n_nationkey % 2 = 0 AS negated, CAST(c AS DOUBLE) AS value FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS c FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY 1) ON c_nationkey = n_nationkey""")
def presented_lines(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    arcs = t.nation.select(F.lit("IS").alias("role"), F.col("n_regionkey").alias("parent"), F.col("n_name").alias("tag"), k.alias("order"), F.when(k % 2 == 0, "negatedTerseLabel").otherwise("label").alias("preferred"))
    labels = t.nation.filter(k % 2 == 0).select(F.col("n_name").alias("tag"), F.lit("negatedTerseLabel").alias("role"), F.concat(F.lit("terse "), F.col("n_name")).alias("label")).unionByName(t.nation.filter(k % 3 == 0).select(F.col("n_name").alias("tag"), F.lit("label").alias("role"), F.concat(F.lit("plain "), F.col("n_name")).alias("label")))
    facts = t.customer.filter("c_nationkey % 5 <> 0").join(t.nation, F.col("c_nationkey") == k).groupBy(F.col("n_name").alias("tag")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return ingest.presented_lines(arcs, labels, facts).select("tag", "label", "negated", "value")


@query(f"""WITH {YEARLY}, f AS (SELECT ticker, CAST(h AS BIGINT) AS horizon, arg_max(revenue, fiscal_year) * (1 + h / 10.0::DOUBLE) AS value FROM yearly CROSS JOIN (VALUES (1), (2)) v(h) WHERE ticker % 3 = 0 GROUP BY 1, 2, h) SELECT ticker, horizon, round(value, 2) AS value FROM f UNION ALL SELECT ticker, 0, round(arg_max(revenue, fiscal_year), 2) FROM yearly WHERE ticker % 3 = 0 GROUP BY 1""")
def anchored_series(t: Tables) -> DataFrame:
    y = t.yearly().select("ticker", "fiscal_year", F.col("revenue").alias("value"))
    last = y.filter("ticker % 3 = 0").groupBy("ticker").agg(F.max_by("value", "fiscal_year").alias("v"))
    f = last.select("ticker", F.explode(F.array(F.lit(1), F.lit(2))).alias("horizon"), "v").withColumn("value", F.col("v") * (1 + F.col("horizon") / 10.0)).drop("v")
    return statements.with_anchor(f, y, ["ticker"], "fiscal_year", "value").withColumn("value", r("value", 2))


@query(f"""WITH {METRICS}, k AS (SELECT *, dense_rank() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rk FROM metrics) SELECT ticker, fiscal_year, round(max(CASE WHEN metric = 'revenue' THEN value END), 2) AS revenue, max(CASE WHEN metric = 'orders' THEN value END) AS orders FROM k WHERE rk <= 3 GROUP BY 1, 2""")
def metric_history(t: Tables) -> DataFrame:
    return statements.history(t.metrics(), "ticker", "metric", "fiscal_year", "value", ["revenue", "orders"], 3).withColumn("revenue", r("revenue", 2))


@query(f"""WITH {METRICS}, j AS (SELECT m.*, c_mktsegment AS sector FROM metrics m JOIN customer ON c_custkey = ticker), k AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY ticker, metric ORDER BY fiscal_year DESC) <= 3), a AS (SELECT ticker, sector, metric, avg(value) AS mean FROM k GROUP BY ALL) SELECT sector, metric, round(median(mean), 4) AS median, CAST(count(*) AS BIGINT) AS n FROM a GROUP BY ALL HAVING count(*) >= 5""")
def industry_cache(t: Tables) -> DataFrame:
    j = t.metrics().join(t.customer.select(F.col("c_custkey").alias("ticker"), F.col("c_mktsegment").alias("sector")), "ticker")
    return statements.benchmark_cache(j, "ticker", "sector", "metric", "fiscal_year", "value", 3, 5)[1].withColumn("median", r("median"))


_PCT = lambda c: f"round(CASE WHEN market_cap <> 0 THEN {c} / market_cap * 100 END, 6)"


@query(f"""WITH {STATEMENTS}, x AS (SELECT *, coalesce(liabilities, assets - equity) AS owed, revenue / 100 - 500 AS shares FROM statements) SELECT ticker, fiscal_year, round(CASE WHEN shares > 0 THEN (current_assets - owed) / shares END, 6) AS ncav_per_share,
round(CASE WHEN shares > 0 THEN (equity - coalesce(goodwill, 0) - coalesce(intangibles, 0)) / shares END, 6) AS tangible_book_per_share,
{_PCT("ocf")} AS ocf_yield, {_PCT("(operating_income + coalesce(da, 0))")} AS ebitda_yield, {_PCT("coalesce(abs(dividends), 0)")} AS dividend_yield, {_PCT("coalesce(abs(buybacks), 0)")} AS buyback_yield,
round(CASE WHEN coalesce(cash, 0) + coalesce(sti, 0) + coalesce(receivables, 0) * 0.75::DOUBLE + coalesce(inventory, 0) * 0.5::DOUBLE - owed > 0 THEN market_cap / (coalesce(cash, 0) + coalesce(sti, 0) + coalesce(receivables, 0) * 0.75::DOUBLE + coalesce(inventory, 0) * 0.5::DOUBLE - owed) END, 6) AS ncav_moderate_ratio FROM x""")
def per_share_and_yields(t: Tables) -> DataFrame:
    names = ["ncav_per_share", "tangible_book_per_share", "ocf_yield", "ebitda_yield", "dividend_yield", "buyback_yield", "ncav_moderate_ratio"]
    s = metrics.add_metrics(t.statements().withColumn("shares", F.col("revenue") / 100 - 500), names)
    return s.select("ticker", "fiscal_year", *[r(n, 6).alias(n) for n in names])


@query(f"""WITH {STATEMENTS}, x AS (SELECT *, make_date(fiscal_year, 12, 31) AS pe, (current_assets - coalesce(liabilities, assets - equity)) AS nc, 2.5::DOUBLE * 1000 AS cap FROM statements), g AS (SELECT *, date_diff('day', pe, DATE '2001-06-30') BETWEEN 0 AND 400 AS ok FROM x)
SELECT ticker, fiscal_year, round(CASE WHEN net_income > 0 THEN cap / net_income END, 6) AS live_pe, round(CASE WHEN equity > 0 THEN cap / equity END, 6) AS live_pb, round(CASE WHEN ok THEN nc / 1000 END, 6) AS live_ncav_per_share, round(CASE WHEN ok AND nc > 0 THEN cap / nc END, 8) AS live_ncav_ratio, round(CASE WHEN operating_income + coalesce(da, 0) > 0 THEN (cap + coalesce(lt_debt, 0) - coalesce(cash, 0)) / (operating_income + coalesce(da, 0)) END, 6) AS live_ev_to_ebitda FROM g""")
def live_panel(t: Tables) -> DataFrame:
    s = t.statements().withColumn("pe", F.make_date(F.col("fiscal_year").cast("int"), F.lit(12), F.lit(31)))
    ncav = F.col("current_assets") - metrics.liabilities()
    s = s.select("ticker", "fiscal_year", F.col("net_income").alias("ttm_net_income"), "equity", F.col("lt_debt").alias("debt"), "cash", metrics.ebitda().alias("ttm_ebitda"), metrics.fresh(ncav, F.col("pe"), F.lit("2001-06-30").cast("date")).alias("ncav"))
    digits = {"live_ncav_ratio": 8}
    return s.select("ticker", "fiscal_year", *[r(c, digits.get(n, 6)).alias(n) for n, c in metrics.live_multiples(F.lit(2.5), F.lit(1000.0)).items()])


@query(f"""WITH {STATEMENTS}, x AS (SELECT *, 5 + fiscal_year % 4 AS n, 1.04::DOUBLE / 1.1::DOUBLE AS q, n_shares FROM (SELECT *, revenue / 1000 AS n_shares FROM statements))
SELECT ticker, fiscal_year, round((ocf * (q * (1 - pow(q, n)) / (1 - q) + pow(q, n) * 1.02::DOUBLE / (0.1::DOUBLE - 0.02::DOUBLE)) + coalesce(coalesce(cash, 0) - coalesce(lt_debt, 0), 0)) / n_shares, 4) AS dcf_per_share, round(CASE WHEN net_income > 0 THEN net_income * 15 / n_shares END, 4) AS oe_per_share, round(CASE WHEN net_income > 0 THEN net_income / 0.08::DOUBLE END, 2) AS oe_by_rate FROM x""")
def value_per_share(t: Tables) -> DataFrame:
    s = t.statements().withColumn("shares", F.col("revenue") / 1000)
    n = (5 + F.col("fiscal_year") % 4).cast("int")
    dcf = valuation.two_stage_dcf(F.col("ocf"), F.lit(0.04), F.lit(0.1), F.lit(0.02), n)
    cash = F.coalesce("cash", F.lit(0.0)) - F.coalesce("lt_debt", F.lit(0.0))
    oe = valuation.capitalised(F.col("net_income"), multiple=F.lit(15.0))
    return s.select("ticker", "fiscal_year", r(valuation.per_share(dcf, F.col("shares"), cash)).alias("dcf_per_share"), r(valuation.per_share(oe, F.col("shares"))).alias("oe_per_share"), r(valuation.capitalised(F.col("net_income"), rate=F.lit(0.08)), 2).alias("oe_by_rate"))


@query(f"""WITH {YEARLY}, v AS (SELECT ticker, fiscal_year, s AS scenario, revenue * f AS a, CASE WHEN n_orders > 2 THEN revenue - 1000 * f END AS b FROM yearly CROSS JOIN (VALUES ('bull', 2.0::DOUBLE), ('bear', 0.5::DOUBLE)) x(s, f)) SELECT ticker, fiscal_year, 'Graham — ' || scenario AS metric, round(a, 4) AS value FROM v UNION ALL SELECT ticker, fiscal_year, 'DCF — ' || scenario, round(b, 4) FROM v WHERE b IS NOT NULL""")
def labelled_values(t: Tables) -> DataFrame:
    x = t.yearly().select("ticker", "fiscal_year", "revenue", "n_orders", F.explode(F.array(F.struct(F.lit("bull").alias("s"), F.lit(2.0).alias("f")), F.struct(F.lit("bear").alias("s"), F.lit(0.5).alias("f")))).alias("x"))
    v = x.select("ticker", "fiscal_year", F.col("x.s").alias("scenario"), (F.col("revenue") * F.col("x.f")).alias("a"), F.when(F.col("n_orders") > 2, F.col("revenue") - 1000 * F.col("x.f")).alias("b"))
    return valuation.labelled(v, ["ticker", "fiscal_year"], {"a": "Graham", "b": "DCF"}).withColumn("value", r("value"))


@query(f"""WITH {STATEMENTS}, q AS (SELECT *, CAST(ticker % 11 AS DOUBLE) / 10 AS qu FROM statements) SELECT ticker, fiscal_year, round(CASE WHEN operating_income > 0 AND coalesce(capex, da, inventory) IS NOT NULL THEN (coalesce(capex, 0) - coalesce(da, 0) + coalesce(inventory, 0)) / operating_income END, 6) AS reinvestment, round(CASE WHEN net_income > 0 THEN ocf / net_income END, 6) AS conversion,
round(CASE WHEN qu <= 0.1 THEN 0.11::DOUBLE WHEN qu >= 0.9 THEN 0.07::DOUBLE WHEN qu <= 0.5 THEN 0.11::DOUBLE - 0.02::DOUBLE * (qu - 0.1::DOUBLE) / 0.4::DOUBLE ELSE 0.09::DOUBLE - 0.02::DOUBLE * (qu - 0.5::DOUBLE) / 0.4::DOUBLE END, 8) AS wacc FROM q""")
def forecast_inputs(t: Tables) -> DataFrame:
    c = F.col
    s = t.statements().withColumn("q", (c("ticker") % 11) / 10.0)
    return s.select("ticker", "fiscal_year", r(forecast.reinvestment_rate(c("capex"), c("da"), c("inventory"), c("operating_income")), 6).alias("reinvestment"), r(forecast.cash_conversion(c("ocf"), c("net_income")), 6).alias("conversion"), r(valuation.by_quantile(c("q"), 0.11, 0.09, 0.07), 8).alias("wacc"))


@query("""WITH c AS (SELECT DATE '1970-01-01' + CAST(quantile_disc(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)), 0.85) AS INT) AS d FROM orders) SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= (SELECT d FROM c) THEN 'train' ELSE 'test' END AS part FROM orders""")
def expanding_cutoff(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    train, test = forecast.split_at(o, "d", F.lit(forecast.cutoff(o, "d")))
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(test.select("o_orderkey", F.lit("test").alias("part")))


@query("""WITH g AS (SELECT o_custkey % 97 AS k, median(o_totalprice) AS median, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) SELECT CAST(k AS BIGINT) AS k, round(median, 4) AS median, CAST(n AS BIGINT) AS n, (SELECT CAST(count(*) AS BIGINT) FROM g WHERE n < 5) AS hidden_groups FROM g WHERE n >= 5""")
def gated_groups(t: Tables) -> DataFrame:
    shown, hidden = screener.gated(t.orders.filter("o_orderkey % 3 = 0").withColumn("k", F.col("o_custkey") % 97), "k", "o_totalprice", 5)
    return shown.withColumn("median", r("median")).crossJoin(F.broadcast(hidden.select("hidden_groups")))


@query(f"""WITH {METRICS}, y AS (SELECT max(fiscal_year) AS m FROM metrics) SELECT metric, CAST(count(DISTINCT ticker) AS BIGINT) AS n, CAST(count(DISTINCT CASE WHEN fiscal_year > m - 2 THEN ticker END) AS BIGINT) AS recent_n, round(count(DISTINCT CASE WHEN fiscal_year > m - 2 THEN ticker END) / (SELECT count(DISTINCT ticker) FROM metrics, y WHERE fiscal_year > m - 2)::DOUBLE, 6) AS recent_rate FROM metrics, y GROUP BY 1""")
def recent_fill_rate(t: Tables) -> DataFrame:
    return screener.recent_fill_rate(t.metrics(), "metric", "ticker", "fiscal_year", 2).select("metric", "n", "recent_n", r("recent_rate", 6).alias("recent_rate"))


@query("""WITH s AS (SELECT c_mktsegment, median(c_acctbal) AS m, count(*) AS n FROM customer GROUP BY 1) SELECT c_custkey, round(c_acctbal, 2) AS value, round(m, 4) AS peer_median, CAST(n AS BIGINT) AS peers FROM customer JOIN s USING (c_mktsegment) WHERE c_custkey = 7""")
def compare_one(t: Tables) -> DataFrame:
    found = screener.compare_one(t.customer, "c_custkey", ["c_nationkey", "c_mktsegment"], "c_acctbal", 7, basis="c_mktsegment")
    return found.select("c_custkey", r("c_acctbal", 2).alias("value"), r("peer_median").alias("peer_median"), "peers")


@query("""SELECT p_partkey FROM part WHERE p_size >= 30 OR p_size < 10""")
def chosen_bands(t: Tables) -> DataFrame:
    bands = screener.bands_for("Size (cm) — mid", "cm", {"Size": [("low", None, 10), ("mid", 10, 30), ("high", 30, None)], "S*": [("any", None, None)]})
    return t.part.filter(screener.in_bands("p_size", bands, ["low", "high"])).select("p_partkey")


@query("""WITH x AS (SELECT o_orderkey, (o_orderkey % 30 - 15) / 100.0::DOUBLE AS d FROM orders) SELECT o_orderkey, CASE WHEN abs(d) <= 0.02 THEN 'ok' WHEN abs(d) <= 0.1 THEN 'minor' ELSE 'major' END AS severity FROM x""")
def benchmark_severity(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", severity((F.col("o_orderkey") % 30 - 15) / 100.0).alias("severity"))


@query("""SELECT c_custkey AS entity, CASE WHEN c_custkey % 3 = 0 THEN 'USD' WHEN c_custkey % 3 = 1 THEN 'EUR' ELSE 'CHF' END AS unit, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n FROM customer""")
def nested_facts(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    fact = F.struct(F.lit(2000).alias("fy"), F.lit("FY").alias("fp"), F.lit("10-K").alias("form"), F.lit(None).cast("date").alias("start"), F.lit("2000-12-31").cast("date").alias("end"), F.col("c_acctbal").alias("val"), F.lit("2001-02-01").cast("date").alias("filed"), F.lit("a").alias("accn"))
    units = F.when(k % 3 == 0, F.create_map(F.lit("EUR"), F.array(fact, fact), F.lit("USD"), F.array(fact))).when(k % 3 == 1, F.create_map(F.lit("GBP"), F.array(fact), F.lit("EUR"), F.array(fact, fact))).otherwise(F.create_map(F.lit("EUR"), F.array(fact, fact), F.lit("CHF"), F.array(fact, fact)))
    docs = t.customer.select(k.alias("entity"), F.create_map(F.lit("us-gaap"), F.create_map(F.lit("Assets"), F.struct(units.alias("units")))).alias("facts"))
    return ingest.explode_facts(docs).groupBy("entity", "unit").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, o_totalprice AS value FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 5 <> 0""")
def current_facts(t: Tables) -> DataFrame:
    k, end = F.col("o_orderkey"), F.date_add(F.col("o_orderdate").cast("date"), 1).cast("string")
    entity = F.when(k % 4 == 0, "me").otherwise("other")
    base = F.create_map(F.lit("concept"), k.cast("string"), F.lit("entity"), entity, F.lit("period"), F.concat(F.lit("2000-01-01T00:00:00/"), end, F.lit("T00:00:00")), F.lit("unit"), F.lit("EUR"))
    dims = F.when(k % 5 == 0, F.map_concat(base, F.create_map(F.lit("axis"), F.lit("x")))).otherwise(base)
    facts = t.orders.select(dims.alias("dimensions"), F.col("o_totalprice").cast("string").alias("value"), F.col("o_orderdate").cast("date").alias("pe"))
    return ingest.current_facts(facts, F.lit("me"), F.col("pe")).select(F.col("concept").cast("long").alias("o_orderkey"), "value")


@query("""SELECT o_orderkey, 'A' AS ticker, o_totalprice AS close, CAST(NULL AS DOUBLE) AS volume FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'B', o_totalprice * 2, 1.0 FROM orders""")
def tidy_prices(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    wide = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, p).alias("close|A"), (p * 2).alias("close|B"), F.lit(1.0).alias("volume|B"))
    return ingest.tidy_prices(wide, ["o_orderkey"], ["close", "volume"])


@query("""SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filing_date, o_orderpriority AS form FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority) <= 2""")
def filing_arrays(t: Tables) -> DataFrame:
    f = t.orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("d"), F.col("o_orderpriority").alias("p")))).alias("f"))
    docs = f.select("o_custkey", F.col("f.d").alias("filing_date"), F.col("f.p").alias("form"))
    return ingest.filing_rows(docs, "o_custkey", ["filing_date", "form"], ["1-URGENT", "2-HIGH"], 2)


@query("""SELECT 'missing column z' AS error UNION ALL SELECT 'column o_totalprice is numeric, not string'""")
def contract_check(t: Tables) -> DataFrame:
    errors = contract_errors(reshape.ensure_columns(t.orders, {"y": "date"}), {"o_orderkey": ["numeric"], "z": ["string"], "o_totalprice": ["string"], "y": ["datetime"]})
    return t.spark.createDataFrame([(e,) for e in errors], "error string")


@query("""SELECT r_name AS section, n_name AS concept, CAST(row_number() OVER (ORDER BY r_regionkey, n_nationkey) AS BIGINT) AS sort_order FROM nation JOIN region ON n_regionkey = r_regionkey""")
def hierarchy_rows(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).orderBy("r_regionkey", "n_nationkey").select("r_name", "n_name").collect()
    tree: dict[str, list[str]] = {}
    for x in rows:
        tree.setdefault(x["r_name"], []).append(x["n_name"])
    flat = ingest.flatten_tree({"all": tree})
    return t.spark.createDataFrame([(x["section"], x["concept"], x["sort_order"]) for x in flat], "section string, concept string, sort_order long")


_PAIRS = (
    ("GFL ENVIRONMENTAL SUBORDINATE VOTI", "GFL Environmental Inc.", "same"), ("Aecon Group Inc", "Alexandria Real Estate Equities, Inc.", "different"), ("Boyd Group Services Inc", "Boyd Gaming Corp", "ambiguous"),
    ("Restaurants Brands International I", "Restaurant Brands International Inc.", "ambiguous"), ("ACCIONES FOMENTO DE CONSTRUCCIO", "ACCIONES FOMENTO DE CONSTRUCCIONES Y CONTRATAS, S.A.", "same"), ("Compagnie de Saint-Gobain S.A.", "SAINT GOBAIN", "same"),
    ("MICRO", "MICROSOFT CORP", "different"), ("", "X Inc", "ambiguous"), ("Inc", "Corp", "ambiguous"), ("Magna International Inc", "Mistras Group Inc", "different"), (None, "A B", "ambiguous"), ("Alphabet Inc Class A", "ALPHABET INC", "same"), ("Acme Corp /NEW/", "Acme Corporation", "same"),
    ("Northern Data Company Limited", "northern data llc", "same"), ("Power Corp Non-Voting", "POWER CORPORATION", "same"), ("A B", "Q R", "ambiguous"),
)


@query("SELECT CAST(k AS BIGINT) AS k, verdict FROM (VALUES " + ", ".join(f"({k}, '{v}')" for k, (_, _, v) in enumerate(_PAIRS)) + ") x(k, verdict) UNION ALL SELECT 1000 + s_suppkey, CASE s_suppkey % 3 WHEN 1 THEN 'different' ELSE 'same' END FROM supplier")
def name_match(t: Tables) -> DataFrame:
    pairs = t.spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(_PAIRS)], "k long, a string, b string")
    m = F.col("s_suppkey") % 3
    other = F.when(m == 0, F.concat("s_name", F.lit(" Inc."))).when(m == 1, "Otherwise Limited").otherwise(F.concat("s_name", F.lit(" Holding")))
    own = t.supplier.select((F.col("s_suppkey") + 1000).alias("k"), F.col("s_name").alias("a"), other.alias("b"))
    return pairs.unionByName(own).select("k", identity.name_match(F.col("a"), F.col("b")).alias("verdict"))
