"""Registration of queries: a function of the tables, beside the DuckDB statement it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a directory as attributes, and the derived ones that several queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def yearly(self) -> DataFrame:
        """Per customer and year: revenue (summed in cents, so that the order of adding does not matter), orders, last filing."""
        return self.orders.groupBy(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fiscal_year")).agg(
            (F.sum(cents("o_totalprice")) / 100.0).alias("revenue"), F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("filed")
        )

    def quarterly(self) -> DataFrame:
        return self.orders.groupBy(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fiscal_year"), F.quarter("o_orderdate").cast("long").alias("quarter")).agg((F.sum(cents("o_totalprice")) / 100.0).alias("revenue"))

    def brand_years(self) -> DataFrame:
        """Per brand and year of shipping: revenue and quantity."""
        sold = self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        return sold.groupBy(F.col("p_brand").alias("brand"), F.year("l_shipdate").cast("long").alias("fiscal_year")).agg((F.sum(cents("l_extendedprice")) / 100.0).alias("revenue"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))

    def metrics(self) -> DataFrame:
        """Long: per customer and year the metrics revenue, orders (even years only) and average."""
        y = self.yearly()
        cells = F.array(F.struct(F.lit("revenue").alias("metric"), F.col("revenue").alias("value")), F.struct(F.when(F.col("fiscal_year") % 2 == 0, "orders").alias("metric"), F.col("n_orders").cast("double").alias("value")), F.struct(F.lit("average").alias("metric"), (F.col("revenue") / F.col("n_orders")).alias("value")))
        return y.select("ticker", "fiscal_year", F.explode(cells).alias("c")).select("ticker", "fiscal_year", "c.metric", "c.value").filter("metric IS NOT NULL")

    def statements(self) -> DataFrame:
        """A wide statement per customer and year in cents, made from order sums so that nulls and zeros occur."""
        y = self.orders.groupBy(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").cast("long").alias("fiscal_year")).agg(
            *[F.sum(F.when(c, cents("o_totalprice"))).cast("double").alias(n) for n, c in statement_items().items()]
        )
        return y.withColumn("interest", F.when(F.col("st_debt").isNotNull(), -F.col("st_debt") / 50)).withColumn("market_cap", F.col("revenue") * 3 - F.coalesce("capex", F.lit(0.0)))


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def statement_items() -> dict[str, Column]:
    """Which orders count for each item of a made-up statement."""
    s, m = F.col("o_orderstatus"), F.col("o_orderkey") % 7
    return {
        "revenue": F.lit(True), "gross_profit": m < 5, "operating_income": m < 3, "net_income": m == 1, "ocf": m < 2, "capex": m == 2, "lt_debt": m == 3, "st_debt": m == 4,
        "equity": m.isin(0, 5), "assets": m != 6, "liabilities": m.isin(2, 3), "cash": s == "F", "sti": m == 0, "receivables": s == "O", "inventory": s == "P", "other_current": m == 5,
        "current_assets": m.isin(0, 1, 2), "current_liabilities": m.isin(3, 6), "da": m == 4, "dividends": m == 6, "buybacks": m == 5, "goodwill": m == 2, "intangibles": m == 4, "retained": m.isin(1, 4),
    }


_M_SQL = "o_orderkey % 7"
_STATEMENT_SQL = {
    "revenue": "true", "gross_profit": f"{_M_SQL} < 5", "operating_income": f"{_M_SQL} < 3", "net_income": f"{_M_SQL} = 1", "ocf": f"{_M_SQL} < 2", "capex": f"{_M_SQL} = 2", "lt_debt": f"{_M_SQL} = 3", "st_debt": f"{_M_SQL} = 4",
    "equity": f"{_M_SQL} IN (0, 5)", "assets": f"{_M_SQL} <> 6", "liabilities": f"{_M_SQL} IN (2, 3)", "cash": "o_orderstatus = 'F'", "sti": f"{_M_SQL} = 0", "receivables": "o_orderstatus = 'O'", "inventory": "o_orderstatus = 'P'", "other_current": f"{_M_SQL} = 5",
    "current_assets": f"{_M_SQL} IN (0, 1, 2)", "current_liabilities": f"{_M_SQL} IN (3, 6)", "da": f"{_M_SQL} = 4", "dividends": f"{_M_SQL} = 6", "buybacks": f"{_M_SQL} = 5", "goodwill": f"{_M_SQL} = 2", "intangibles": f"{_M_SQL} = 4", "retained": f"{_M_SQL} IN (1, 4)",
}

CENTS = "CAST(round({0} * 100) AS BIGINT)"
YEARLY = """yearly AS (SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS revenue, CAST(count(*) AS BIGINT) AS n_orders, max(o_orderdate) AS filed FROM orders GROUP BY 1, 2)"""
QUARTERLY = """quarterly AS (SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS revenue FROM orders GROUP BY 1, 2, 3)"""
BRAND_YEARS = """brand_years AS (SELECT p_brand AS brand, CAST(year(l_shipdate) AS BIGINT) AS fiscal_year,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS revenue, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
METRICS = YEARLY + """, metrics AS (
  SELECT ticker, fiscal_year, 'revenue' AS metric, revenue AS value FROM yearly UNION ALL
  SELECT ticker, fiscal_year, 'orders', CAST(n_orders AS DOUBLE) FROM yearly WHERE fiscal_year % 2 = 0 UNION ALL
  SELECT ticker, fiscal_year, 'average', revenue / n_orders FROM yearly)"""
_ITEMS_SQL = ", ".join(f"CAST(sum(CASE WHEN {c} THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) AS {n}" for n, c in _STATEMENT_SQL.items())
STATEMENTS = f"""items AS (SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, {_ITEMS_SQL} FROM orders GROUP BY 1, 2),
statements AS (SELECT *, -st_debt / 50 AS interest, revenue * 3 - coalesce(capex, 0) AS market_cap FROM items)"""


def query(sql: str):
    """Register a function of Tables under its own name, with its oracle (empty: none)."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r(column: Column | str, digits: int = 4) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def flat(column: Column) -> Column:
    """Without the noise, and the sign, of a difference that is 0."""
    return F.when(F.abs(column) < 1e-6, F.lit(0.0)).otherwise(column)


def day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")
