"""Whether two company names mean one legal entity, and what follows for listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.dedup import top_n

#: What is dropped from an upper-cased name, in this order; a hyphen parts words.
DROPPED = ("/[A-Z0-9]+/", "[.,'&]", "-", r"\bCLASS\s*[A-Z]\b", r"\bSUBORDINATE\s+VOT\w*\b", r"\bNON[\s-]?VOT\w*\b", r"\bVOTING\b", r"\b(INC|CORP|CORPORATION|LTD|LIMITED|LLC|PLC|CO|COMPANY|SA|NV|AG|NEW)\b")
#: Fixed value: letters that a cut-off last word must have at least.
CUT_OFF = 8
HOME = "US"


def normalised_name(name: Column) -> Column:
    """Upper-cased, without marks, legal forms, share classes and registry tags; words parted by one space. Null counts as empty."""
    plain = F.upper(F.coalesce(name, F.lit("")))
    for pattern in DROPPED:
        plain = F.regexp_replace(plain, f"(?U){pattern}", " " if pattern == "-" else "")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def _cut_off(a: Column, b: Column) -> Column:
    """Whether ``a`` is ``b`` cut off within a word: all words but the last agree in place, the last begins b's."""
    x, y = F.split(a, " "), F.split(b, " ")
    n = F.size(x)
    last = F.element_at(x, -1)
    own = F.coalesce(F.get(y, n - 1), F.lit(""))
    return (n <= F.size(y)) & (F.slice(x, F.lit(1), n - 1) == F.slice(y, F.lit(1), n - 1)) & (F.length(last) >= CUT_OFF) & F.startswith(own, last)


def verdict(a: Column, b: Column) -> Column:
    """same, ambiguous or different, of two normalised names. A name without a word of two letters is ambiguous."""
    shorter, longer = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    words = lambda n: F.array_distinct(F.filter(F.split(n, " "), lambda w: F.length(w) > 1))
    x, y = words(a), words(b)
    shared, least = F.size(F.array_intersect(x, y)), F.least(F.size(x), F.size(y))
    return (
        F.when((a == "") | (b == ""), "ambiguous").when(a == b, "same").when(_cut_off(shorter, longer), "same").when(least == 0, "ambiguous")
        .when(shared == least, "same").when(shared == 0, "different").otherwise("ambiguous")
    )


def name_match(a: Column, b: Column) -> Column:
    return verdict(normalised_name(a), normalised_name(b))


def market_collisions(df: DataFrame, ticker: str = "ticker", market: str = "market", company: str = "company") -> DataFrame:
    """``ticker, names`` of tickers that stand in several markets (null: home) for companies that are not all the same.

    A ticker has a handful of rows, so its names are compared within one array.
    """
    names = df.groupBy(ticker).agg(F.count_distinct(F.coalesce(market, F.lit(HOME))).alias("markets"), F.sort_array(F.collect_set(normalised_name(F.col(company)))).alias("names"))
    apart = F.exists("names", lambda x: F.exists("names", lambda y: verdict(x, y) != "same"))
    return names.filter((F.col("markets") > 1) & apart).select(ticker, "names")


def one_market(df: DataFrame, ticker: str = "ticker", market: str = "market", company: str = "company") -> DataFrame:
    """``df`` with one row of each ticker that stands in several markets: the fullest, of equals the home market's. A collision raises.

    Rows that share ticker and market are left alone where the ticker has no other market.
    """
    clash = market_collisions(df, ticker, market, company).limit(20).collect()
    if clash:
        raise ValueError("tickers of different companies: " + "; ".join(f"{r[ticker]}: {', '.join(r['names'])}" for r in clash))
    own = df.withColumn(market, F.coalesce(market, F.lit(HOME)))
    several = own.groupBy(ticker).agg(F.count_distinct(market).alias("__m")).filter("__m > 1").select(ticker)
    filled = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
    best = top_n(own.join(several, ticker, "left_semi"), [ticker], [filled.desc(), (F.col(market) == HOME).desc(), F.asc(market), F.asc_nulls_last(company)])
    return best.unionByName(own.join(several, ticker, "left_anti"))


def admit(candidates: DataFrame, registry: DataFrame, existing: DataFrame) -> DataFrame:
    """``candidates`` (ticker, company) with ``status`` (admitted, dual listed, excluded) and ``reason``, against ``registry`` (ticker, title).

    In order: no entry, a title that is not the same company's, a ticker that is there already.
    """
    known = registry.select(F.upper("ticker").alias("__k"), F.col("title").alias("__title"))
    have = existing.select(F.col("ticker").alias("__have")).distinct()
    j = candidates.join(known, F.upper("ticker") == F.col("__k"), "left").join(have, F.col("ticker") == F.col("__have"), "left")
    match = name_match(F.col("company"), F.col("__title"))
    reason = F.when(F.col("__k").isNull(), "no entry").when(match != "same", match)
    status = F.when(reason.isNotNull(), "excluded").when(F.col("__have").isNotNull(), "dual listed").otherwise("admitted")
    return j.select(*candidates.columns, status.alias("status"), reason.alias("reason"))


def check_distinct(df: DataFrame, ticker: str = "ticker") -> None:
    """Raise if a ticker occurs twice; nothing is resolved."""
    twice = df.groupBy(ticker).count().filter("count > 1").limit(20).collect()
    if twice:
        raise ValueError(f"repeated tickers: {sorted(str(r[ticker]) for r in twice)}")
