"""From reported facts to annual metrics, as one lazy plan of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import clean, metrics, reshape


def clean_annual(facts: DataFrame, canonical: Mapping[str, str], rank: Mapping[str, int], first_year: int = 1990, last_year: int = 2030) -> DataFrame:
    """One value per ticker, statement, concept and fiscal year.

    Takes ``ticker, stmt, concept, fiscal_year, period_start, period_end, value, filed``; years outside the bounds and shapes
    shorter than a year are left out, snapshots and rows without a year stay (a year is compared with the period's end where it is known).
    """
    shaped = facts.filter(F.coalesce(F.col("fiscal_year").between(first_year, last_year), F.lit(True))).withColumn("period_shape", clean.period_shape(F.col("period_start"), F.col("period_end")))
    annual = shaped.filter(F.col("period_shape").isin("snapshot", "FY_or_TTM"))
    return clean.choose_fiscal_year(clean.collapse_synonyms(annual, "concept", canonical, rank), ["ticker", "stmt", "concept"])


def annual_metrics(annual: DataFrame, items: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Long ``ticker, fiscal_year, metric, value`` of the named metrics; items that are absent count as unknown."""
    wide = reshape.widen(annual, ["ticker", "fiscal_year"], "concept", "value", items)
    return reshape.lengthen(metrics.add_metrics(wide, list(names)), ["ticker", "fiscal_year"], {n: n for n in names})
