"""Forecast panels, models for growth quantiles and losses, and the algebra around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.asof import at_offset

QUANTILES = (0.10, 0.25, 0.50, 0.75, 0.90)


def features(panel: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """``panel`` with ``features``: numbers (what is not one counts as missing, with a flag of its own) and codes of categories.

    A column that is missing, or null throughout, is one of missing values. Codes are a category's rank by a bounded hash, so no pass is needed.
    """
    from pyspark.ml.feature import VectorAssembler

    parts = []
    for c in numeric:
        own = F.col(c).cast("string").try_cast("double") if c in panel.columns else F.lit(None).cast("double")
        own = F.when(~F.isnan(own), own)
        parts += [F.coalesce(own, F.lit(0.0)).alias(f"__n_{c}"), own.isNull().cast("double").alias(f"__m_{c}")]
    for c in categories:
        parts.append(F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(31)) + 1).otherwise(0).cast("double").alias(f"__c_{c}"))
    names = [f"__n_{c}" for c in numeric] + [f"__m_{c}" for c in numeric] + [f"__c_{c}" for c in categories]
    return VectorAssembler(inputCols=names, outputCol="features").transform(panel.select("*", *parts)).drop(*names)


def fit_growth(train: DataFrame, predict: DataFrame, target: str = "log_growth", quantiles: Sequence[float] = QUANTILES, trees: int = 20, depth: int = 3, seed: int = 1) -> DataFrame:
    """``predict`` with ``growth``, an array of predicted quantiles in rising order: boosted trees give the centre, quantiles of the
    training residuals (approximate, so of bounded memory) the spread. Both frames have ``features``; rows without a target teach nothing."""
    from pyspark.ml.regression import GBTRegressor

    known = train.filter(F.col(target).isNotNull())
    model = GBTRegressor(labelCol=target, featuresCol="features", predictionCol="__p", maxIter=trees, maxDepth=depth, seed=seed).fit(known)
    spread = model.transform(known).agg(F.percentile_approx(F.col(target) - F.col("__p"), list(quantiles), 10_000).alias("s")).first()["s"]
    return model.transform(predict).withColumn("growth", rearranged([F.col("__p") + s for s in spread])).drop("__p")


def fit_loss(train: DataFrame, predict: DataFrame, target: str = "is_loss", trees: int = 20, depth: int = 3, seed: int = 1) -> DataFrame:
    """``predict`` with ``p_loss`` from boosted trees; where the target has one class only, that class's share (0 or 1)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    known = train.filter(F.col(target).isNotNull())
    classes = [r[0] for r in known.select(target).distinct().collect()]
    if len(classes) < 2:
        return predict.withColumn("p_loss", F.lit(float(classes[0]) if classes else None).cast("double"))
    held = F.pmod(F.xxhash64("features"), F.lit(5)) == 0
    model = GBTClassifier(labelCol=target, featuresCol="features", maxIter=trees, maxDepth=depth, seed=seed, validationIndicatorCol="__held").fit(known.withColumn("__held", held))
    return model.transform(predict).withColumn("p_loss", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def reinvestment_rate(capex: Column, da: Column, change_wc: Column, after_tax: Column) -> Column:
    """Net investment over positive operating profit after tax; unknown terms count 0, all unknown gives null."""
    known = F.coalesce(capex, da, change_wc).isNotNull()
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return F.when(known & (after_tax > 0), (z(capex) - z(da) + z(change_wc)) / after_tax)


def cash_conversion(fcf: Column, net_income: Column) -> Column:
    return F.when(net_income > 0, fcf / net_income)


def cutoff(df: DataFrame, as_of: str, share: float = 0.85):
    """The date that a share of the dated rows does not exceed (nearest rank); None without any."""
    return df.agg(F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY datediff(`{as_of}`, DATE '1970-01-01'))").alias("d")).select(F.date_from_unix_date(F.col("d").cast("int"))).first()[0]


def log_growth(now: Column, later: Column) -> Column:
    return F.when((now > 0) & (later > 0), F.ln(later) - F.ln(now))


def training_panel(df: DataFrame, key: str, year: str, value: str, horizons: Sequence[int]) -> DataFrame:
    """Each row once per horizon with the value exactly that many years on, its log growth and whether it is a loss."""
    wide = df
    for h in horizons:
        wide = at_offset(wide, [key], year, value, h, f"__f{h}")
    rows = F.explode(F.array(*[F.struct(F.lit(h).cast("long").alias("horizon"), F.col(f"__f{h}").alias("future")) for h in horizons])).alias("h")
    panel = wide.select(*df.columns, rows).select(*df.columns, "h.horizon", "h.future")
    return panel.withColumn("log_growth", log_growth(F.col(value), F.col("future"))).withColumn("is_loss", F.when(F.col("future").isNotNull(), (F.col("future") < 0).cast("long")))


def rearranged(quantiles: Sequence[Column]) -> Column:
    """Predicted quantiles in rising order."""
    return F.array_sort(F.array(*quantiles))


def hurdle(base: Column, growth: Column, p_loss: Column, quantile: float) -> Column:
    """0 for a base of 0 or less or where the chance of a loss reaches the quantile, else the base grown."""
    return F.when((base <= 0) | (p_loss >= quantile), F.lit(0.0)).otherwise(base * F.exp(growth))


def decile(df: DataFrame, keys: Sequence[str], value: str, least: int = 10) -> DataFrame:
    """``decile`` 1 to 10 of each value within its group: right-closed bins at interpolated edges, equal edges merged.

    Groups under ``least`` non-null values have none. Edges are exact: see ``_edges``.
    """
    edges = _edges(df, keys, value, [k / 10 for k in range(11)])
    joined = df.join(edges, list(keys)).withColumn("__e", F.array_distinct("__e"))
    inner = F.slice("__e", 2, F.greatest(F.size("__e") - 2, F.lit(0)))
    place = F.size(F.filter(inner, lambda e: e < F.col(value))) + 1
    return joined.withColumn("decile", F.when((F.col("__n") >= least) & F.col(value).isNotNull(), place).cast("long")).drop("__e", "__n")


def _edges(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], buckets: int = 1024) -> DataFrame:
    """``keys, __e, __n``: interpolated quantiles of each group, and how many values it has, without gathering a group anywhere.

    A histogram of each group over equal steps between its least and greatest value tells which buckets hold the ranks that
    are needed; only the distinct values of those are counted again and numbered, so what one task sees is one bucket.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    ends = rows.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count(F.lit(1)).alias("__n"))
    step = F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * buckets), F.lit(buckets - 1))).otherwise(0)
    placed = rows.join(ends, list(keys)).withColumn("__b", step.cast("int"))
    histogram = placed.groupBy(*keys, "__b", "__n").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")
    ranks = F.array(*[F.floor(F.lit(p) * (F.col("__n") - 1)) + k for p in shares for k in (0, 1)])
    wanted = F.array_distinct(F.filter(ranks, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__c"))))
    busy = histogram.withColumn("__before", before).withColumn("__w", wanted).filter(F.size("__w") > 0).select(*keys, "__b", "__before", "__w")
    inside = placed.join(busy, [*keys, "__b"]).groupBy(*keys, "__b", "__before", "__w", "__n", "__v").agg(F.count(F.lit(1)).alias("__c"))
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    hit = inside.withColumn("__u", upto).withColumn("__r", F.explode(F.filter("__w", lambda r: (r >= F.col("__u") - F.col("__c")) & (r < F.col("__u")))))
    seen = hit.groupBy(*keys, "__n").agg(F.map_from_entries(F.collect_list(F.struct("__r", "__v"))).alias("__m"))

    def edge(p: float) -> Column:
        at = F.lit(p) * (F.col("__n") - 1)
        low = F.element_at("__m", F.floor(at))
        high = F.coalesce(F.try_element_at("__m", F.floor(at) + 1), low)
        return low + (high - low) * (at - F.floor(at))

    return seen.select(*keys, F.array(*map(edge, shares)).alias("__e"), "__n")


def auc(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """ROC-AUC of each group by mean ranks of ties; null where a class is absent."""
    ties = Window.partitionBy(*keys, score)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(score)) + (F.count(F.lit(1)).over(ties) - 1) / 2
    pos = F.sum((F.col(label) == 1).cast("long"))
    neg = F.sum((F.col(label) == 0).cast("long"))
    ranked = df.withColumn("__r", rank)
    return ranked.groupBy(*keys).agg(F.when((pos > 0) & (neg > 0), (F.sum(F.when(F.col(label) == 1, F.col("__r"))) - pos * (pos + 1) / 2) / (pos * neg)).alias("auc"))


def split_at(df: DataFrame, as_of: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Rows known by the cutoff, and later ones; rows without a date are in neither."""
    return df.filter(F.col(as_of) <= cutoff), df.filter(F.col(as_of) > cutoff)


def walk_forward(df: DataFrame, as_of: str, boundaries: Sequence) -> list[tuple[DataFrame, DataFrame]]:
    """For each pair of neighbouring boundaries the rows known by the first, and those up to the second."""
    return [(df.filter(F.col(as_of) <= F.lit(a)), df.filter((F.col(as_of) > F.lit(a)) & (F.col(as_of) <= F.lit(b)))) for a, b in zip(boundaries, boundaries[1:], strict=False)]
