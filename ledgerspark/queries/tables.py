"""Table maintenance, data checks, ingestion shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators import quality, upsert
from ledgerspark.operators.dedup import top_n
from ledgerspark.queries.registry import QUARTERLY, YEARLY, Tables, query, r
from ledgerspark.sources import ingest

_OLD = "old AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 4 <> 0), fresh AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 3 <> 0)"


def _states(t: Tables) -> tuple[DataFrame, DataFrame]:
    o = t.orders
    old = o.filter("o_orderkey % 4 <> 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("v"))
    fresh = o.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v"))
    return old, fresh


@query(f"""WITH {_OLD} SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN n.v WHEN n.o_orderkey IS NULL THEN o.v WHEN n.v <> o.v THEN n.v ELSE o.v END AS v FROM old o FULL JOIN fresh n ON o.o_orderkey = n.o_orderkey""")
def upsert_state(t: Tables) -> DataFrame:
    return upsert.merge(*_states(t), ["o_orderkey"]).select("o_orderkey", "v")


@query(f"""WITH {_OLD} SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN n.v WHEN n.o_orderkey IS NULL THEN o.v WHEN n.v IS DISTINCT FROM o.v AND o.o_custkey % 2 = 0 THEN n.v ELSE o.v END AS v FROM old o FULL JOIN fresh n ON o.o_orderkey = n.o_orderkey WHERE NOT (n.o_orderkey IS NULL AND o.o_custkey % 5 = 0)""")
def owned_merge(t: Tables) -> DataFrame:
    old, fresh = _states(t)
    return upsert.merge(old, fresh, ["o_orderkey"], update_if=F.col("t.o_custkey") % 2 == 0, delete_unmatched=F.col("t.o_custkey") % 5 == 0, null_safe=True).select("o_orderkey", "v")


@query(f"""WITH {_OLD} SELECT CASE WHEN o.o_orderkey IS NULL THEN 'new' WHEN n.o_orderkey IS NULL THEN 'orphan' WHEN n.v <> o.v THEN 'modified' ELSE 'matched' END AS status, CAST(count(*) AS BIGINT) AS n FROM old o FULL JOIN fresh n ON o.o_orderkey = n.o_orderkey GROUP BY 1""")
def dry_run(t: Tables) -> DataFrame:
    return upsert.classify(*_states(t), ["o_orderkey"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_OLD} SELECT o_orderkey, v FROM old WHERE NOT (o_custkey IN (SELECT o_custkey FROM fresh) AND o_orderkey NOT IN (SELECT o_orderkey FROM fresh))""")
def orphan_delete(t: Tables) -> DataFrame:
    return upsert.delete_orphans(*_states(t), ["o_orderkey"], ["o_custkey"]).select("o_orderkey", "v")


@query(f"""WITH {_OLD} SELECT o_orderkey, v FROM fresh UNION ALL SELECT o_orderkey, v FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)""")
def replace_keys(t: Tables) -> DataFrame:
    return upsert.replace_keys(*_states(t), ["o_orderkey"]).select("o_orderkey", "v")


@query(f"""WITH {_OLD} SELECT o.o_orderkey, coalesce(n.v, o.v) AS v FROM old o LEFT JOIN fresh n ON o.o_orderkey = n.o_orderkey""")
def preserve_fields(t: Tables) -> DataFrame:
    old, fresh = _states(t)
    return old.join(fresh.select("o_orderkey", F.col("v").alias("n")), "o_orderkey", "left").select("o_orderkey", upsert.preserve(F.col("n"), F.col("v")).alias("v"))


@query("""SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_groups(t: Tables) -> DataFrame:
    return quality.duplicates(t.orders.withColumn("y", F.year("o_orderdate").cast("long")), ["o_custkey", "y"])


@query(f"""WITH {QUARTERLY}, {YEARLY}, q AS (SELECT ticker, fiscal_year, sum(revenue) FILTER (NOT (ticker % 10 = 0 AND quarter = 2)) AS total FROM quarterly GROUP BY 1, 2) SELECT fiscal_year, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (abs(revenue - total) > 0.001 * abs(revenue)) AS BIGINT) AS diverging FROM yearly JOIN q USING (ticker, fiscal_year) GROUP BY 1""")
def qsum_rate(t: Tables) -> DataFrame:
    total = t.quarterly().groupBy("ticker", "fiscal_year").agg(F.sum(F.when(~((F.col("ticker") % 10 == 0) & (F.col("quarter") == 2)), F.col("revenue"))).alias("total"))
    j = t.yearly().join(total, ["ticker", "fiscal_year"])
    return j.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("n"), F.count_if(quality.divergence(F.col("revenue"), F.col("total"), 0.001)).alias("diverging"))


@query("""SELECT c_custkey AS ticker, 'orders' AS reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997) UNION ALL SELECT c_custkey, 'segment' FROM customer WHERE c_mktsegment IS NULL""")
def coverage_gaps(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("ticker"), "c_mktsegment")
    seen = t.orders.filter(F.year("o_orderdate") == 1997).select(F.col("o_custkey").alias("ticker"))
    return quality.missing(c, seen, ["ticker"], "orders").unionByName(c.filter("c_mktsegment IS NULL").select("ticker", F.lit("segment").alias("reason")))


@query("""WITH a AS (SELECT o_custkey AS ticker, max(year(o_orderdate)) AS ref, max(CASE WHEN o_orderstatus = 'P' THEN year(o_orderdate) END) AS latest FROM orders GROUP BY 1) SELECT ticker, CASE WHEN latest IS NULL THEN 'missing' WHEN latest < ref THEN 'stale' ELSE 'fresh' END AS status, CAST(ref - latest AS DOUBLE) AS years_behind FROM a""")
def staleness(t: Tables) -> DataFrame:
    a = t.orders.withColumn("y", F.year("o_orderdate")).groupBy(F.col("o_custkey").alias("ticker")).agg(F.max("y").alias("ref"), F.max(F.when(F.col("o_orderstatus") == "P", F.col("y"))).alias("latest"))
    return a.select("ticker", quality.staleness(F.col("latest"), F.col("ref")).alias("status"), (F.col("ref") - F.col("latest")).cast("double").alias("years_behind"))


@query("""WITH x AS (SELECT o_orderkey, o_totalprice AS a, CASE o_orderkey % 5 WHEN 0 THEN o_totalprice * 1.001::DOUBLE WHEN 1 THEN -o_totalprice WHEN 2 THEN o_totalprice * 1000 WHEN 3 THEN o_totalprice * 1.3::DOUBLE END AS b FROM orders)
SELECT o_orderkey, CASE WHEN b IS NULL THEN NULL WHEN abs(a - b) <= 0.005 * greatest(abs(a), abs(b)) THEN 'match' WHEN abs(a + b) <= 0.005 * greatest(abs(a), abs(b)) THEN 'sign' WHEN abs(round(log10(abs(a / b)))) >= 0.5 AND abs(abs(a) - abs(b) * pow(10.0::DOUBLE, round(log10(abs(a / b))))) <= 0.005 * greatest(abs(a), abs(b) * pow(10.0::DOUBLE, round(log10(abs(a / b))))) THEN 'scale' ELSE 'mismatch' END AS verdict FROM x""")
def reconcile_flags(t: Tables) -> DataFrame:
    m, v = F.col("o_orderkey") % 5, F.col("o_totalprice")
    b = F.when(m == 0, v * 1.001).when(m == 1, -v).when(m == 2, v * 1000).when(m == 3, v * 1.3)
    return t.orders.select("o_orderkey", quality.reconcile(v, b).alias("verdict"))


@query("""SELECT o_custkey AS ticker, o_orderpriority AS cluster, CASE WHEN count(DISTINCT o_custkey) OVER p >= 1200 THEN 'critical' ELSE 'minor' END AS severity FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) WINDOW p AS (PARTITION BY o_orderpriority)""")
def cluster_severity(t: Tables) -> DataFrame:
    f = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderpriority").alias("cluster")).distinct().withColumn("severity", F.lit("minor"))
    return quality.escalate(f, ["cluster"], "ticker", "severity", 1200).select("ticker", "cluster", "severity")


@query("""WITH n AS (SELECT c_nationkey AS c, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT c_nationkey AS c, count(*) AS before FROM customer WHERE c_custkey % 4 <> 0 AND c_nationkey <> 3 GROUP BY 1)
SELECT n.c, CASE WHEN before IS NULL THEN 'new' WHEN n - before >= 15 AND n - before >= 0.2 * before THEN 'grown' ELSE 'steady' END AS change FROM n LEFT JOIN b USING (c)""")
def cluster_growth(t: Tables) -> DataFrame:
    count = lambda df: df.groupBy(F.col("c_nationkey").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return quality.cluster_growth(count(t.customer), count(t.customer.filter("c_custkey % 4 <> 0 AND c_nationkey <> 3")), ["c"], 15).select("c", "change")


@query("""SELECT CAST(json_extract_string(props, '$.' || k) AS VARCHAR) AS value, k AS key, CAST(count(*) AS BIGINT) AS n FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1, 2""")
def props_json(t: Tables) -> DataFrame:
    return ingest.json_pairs(t.events, "props").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH v AS (SELECT DISTINCT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag <> 'R'), m AS (SELECT *, min(d) OVER (PARTITION BY l_partkey) AS first FROM v), k AS (SELECT l_partkey, min(CASE WHEN d = first THEN l_suppkey END) AS supplier, count(CASE WHEN d = first THEN 1 END) AS n FROM m GROUP BY 1)
SELECT l_partkey, CASE WHEN n = 1 THEN 'admitted' ELSE 'unresolved' END AS status, CAST(CASE WHEN n = 1 THEN supplier END AS DOUBLE) AS supplier FROM k""")
def admission(t: Tables) -> DataFrame:
    v = t.lineitem.filter("l_returnflag <> 'R'").select("l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("d")).distinct()
    first = v.withColumn("first", F.min("d").over(Window.partitionBy("l_partkey"))).filter("d = first")
    k = first.groupBy("l_partkey").agg(F.min("l_suppkey").alias("supplier"), F.count(F.lit(1)).alias("n"))
    return k.select("l_partkey", F.when(F.col("n") == 1, "admitted").otherwise("unresolved").alias("status"), F.when(F.col("n") == 1, F.col("supplier")).cast("double").alias("supplier"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'rejected' WHEN row_number() OVER (PARTITION BY o_custkey, year(o_orderdate), o_orderstatus = 'P' ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 THEN 'chosen' ELSE 'superseded' END AS status FROM orders""")
def amendment_choice(t: Tables) -> DataFrame:
    o = t.orders.withColumn("y", F.year("o_orderdate")).withColumn("bad", F.col("o_orderstatus") == "P")
    rank = F.row_number().over(Window.partitionBy("o_custkey", "y", "bad").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")))
    return o.select("o_orderkey", F.when(F.col("bad"), "rejected").when(rank == 1, "chosen").otherwise("superseded").alias("status"))


@query("""SELECT CAST(o_custkey AS BIGINT) AS ticker, CASE WHEN max(o_orderdate) IS NULL THEN 'new' WHEN date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-01') <= 60 THEN 'fresh' ELSE 'stale' END AS state FROM (SELECT c_custkey AS o_custkey, o_orderdate FROM customer LEFT JOIN orders ON c_custkey = o_custkey) GROUP BY 1""")
def incremental_scope(t: Tables) -> DataFrame:
    universe = t.customer.select(F.col("c_custkey").alias("ticker"))
    have = t.orders.select(F.col("o_custkey").alias("ticker"), F.col("o_orderdate").cast("date").alias("d"))
    return ingest.incremental_scope(universe, have, ["ticker"], "d", F.lit("2001-08-01").cast("date"), 60).select("ticker", "state")


@query("""SELECT status, CAST(n AS BIGINT) AS n, CAST(worst AS BIGINT) AS worst, sample FROM (SELECT o_orderstatus AS status, count(*) AS n, max(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE 1 END) AS worst, array_to_string((list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey))[1:3], ',') AS sample FROM orders GROUP BY 1)""")
def severity_samples(t: Tables) -> DataFrame:
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 3).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(1).cast("long")
    o = t.orders.select(F.col("o_orderstatus").alias("status"), rank.alias("rank"), "o_orderkey", "o_totalprice")
    kept = top_n(o, ["status"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).groupBy("status").agg(F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), F.col("o_orderkey").alias("k")))).alias("s"))
    sums = o.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("worst"))
    return sums.join(kept, "status").select("status", "n", "worst", F.array_join(F.transform("s", lambda x: x["k"].cast("string")), ",").alias("sample"))


@query("""SELECT CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, event_type AS stage, CAST(count(*) AS BIGINT) AS runs, CAST(count(*) FILTER (value < 10) AS BIGINT) AS failed, round(max(value), 4) AS slowest, CAST(arg_max(event_id, (ts, event_id)) AS BIGINT) AS latest FROM events GROUP BY 1, 2""")
def run_log(t: Tables) -> DataFrame:
    g = t.events.groupBy(F.date_trunc("month", "ts").cast("date").cast("string").alias("month"), F.col("event_type").alias("stage"))
    return g.agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("value") < 10).alias("failed"), r(F.max("value")).alias("slowest"), F.max_by("event_id", F.struct("ts", "event_id")).alias("latest"))
