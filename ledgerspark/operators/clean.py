"""Cleaning and restatement of reported facts: period shapes, synonyms, fiscal-year choice, quarters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.dedup import best_priority, top_n

#: Day counts of a reporting period and their shapes.
SHAPES = ((70, 100, "Q_standalone"), (160, 200, "YTD_6M"), (250, 290, "YTD_9M"), (350, 380, "FY_or_TTM"))


def period_shape(start: Column, end: Column) -> Column:
    """Shape of a period by its days; a null start is a snapshot, an unlisted length ``other_<n>d``."""
    days = F.datediff(end, start)
    shape = F.when(start.isNull(), F.lit("snapshot"))
    for low, high, label in SHAPES:
        shape = shape.when(days.between(low, high), F.lit(label))
    return shape.otherwise(F.concat(F.lit("other_"), days.cast("string"), F.lit("d")))


def collapse_synonyms(df: DataFrame, label: str, canonical: Mapping[str, str], rank: Mapping[str, int]) -> DataFrame:
    """``label`` renamed to its canonical form, with ``priority`` of the label as reported (unlisted: 999)."""
    names = F.create_map(*[F.lit(x) for kv in canonical.items() for x in kv])
    ranks = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    return df.withColumn("priority", F.coalesce(ranks[F.col(label)], F.lit(999)).cast("long")).withColumn(label, F.coalesce(names[F.col(label)], F.col(label)))


def choose_fiscal_year(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and fiscal year, then one fiscal year per key and period end.

    Rows whose period ends before their year are comparatives and go. A full-year shape, the latest filing, the best
    priority and the greatest value win; of years that claim one period end the smallest stays.
    """
    usable = df.filter(F.coalesce(F.year("period_end") >= F.col("fiscal_year"), F.col("fiscal_year").isNull()))
    full = (F.col("period_shape") == "FY_or_TTM").desc_nulls_last()
    one = top_n(usable, [*keys, "fiscal_year"], [full, F.desc_nulls_last("period_end"), F.desc_nulls_last("filed"), F.asc_nulls_last("priority"), F.desc_nulls_last("value")])
    return top_n(one, [*keys, "period_end"], [F.asc_nulls_last("fiscal_year"), F.desc_nulls_last("value")])


def fill_from(df: DataFrame, keys: Sequence[str], concept: str, source: str, target: str) -> DataFrame:
    """Rows of ``source`` copied as ``target`` where the key has none; the copies are marked derived."""
    have = df.filter(F.col(concept) == target).select(*keys).distinct()
    added = df.filter(F.col(concept) == source).join(have, list(keys), "left_anti").withColumn(concept, F.lit(target)).withColumn("is_derived", F.lit(True))
    return df.unionByName(added.select(df.columns))


def pin_tag(df: DataFrame, keys: Sequence[str], is_annual: Column, priority: str) -> DataFrame:
    """Only rows of the tag that feeds the annual value; keys without an annual row keep their best tag."""
    w = Window.partitionBy(*keys)
    pin = F.coalesce(F.min(F.when(is_annual, F.col(priority))).over(w), F.min(priority).over(w))
    return df.withColumn("__pin", pin).filter(F.col(priority) == F.col("__pin")).drop("__pin")


def derive_quarters(df: DataFrame, keys: Sequence[str], additive: Column, shape: str = "shape", value: str = "value") -> DataFrame:
    """``keys, q1..q4``: a reported standalone quarter, else the difference of year-to-date values, else null.

    Shapes: Q1 to Q4 (standalone), YTD2, YTD3 and FY. What is not additive is never derived.
    """
    v = lambda s: F.max(F.when(F.col(shape) == s, F.col(value)))
    wide = df.groupBy(*keys).agg(F.max(additive).alias("add"), *[v(s).alias(s.lower()) for s in ("Q1", "Q2", "Q3", "Q4", "YTD2", "YTD3", "FY")])
    minus = lambda a, b: F.when(F.col("add"), F.col(a) - F.col(b))
    return wide.select(*keys, "q1", F.coalesce("q2", minus("ytd2", "q1")).alias("q2"), F.coalesce("q3", minus("ytd3", "ytd2")).alias("q3"), F.coalesce("q4", minus("fy", "ytd3")).alias("q4"))


def year_from_quarters(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """``keys, value, is_derived``: the reported year, else the sum of its quarters where all four are there."""
    wide = df.groupBy(*keys).agg(F.max(F.when(F.col(period) == "FY", F.col(value))).alias("fy"), F.count(F.when(F.col(period) != "FY", F.col(value))).alias("n"), F.sum(F.when(F.col(period) != "FY", F.col(value))).alias("total"))
    found = wide.withColumn(value, F.coalesce("fy", F.when(F.col("n") == 4, F.col("total"))))
    return found.filter(F.col(value).isNotNull()).select(*keys, value, F.col("fy").isNull().alias("is_derived"))


def orphans(reported: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were reported but not kept."""
    return reported.select(*keys).distinct().join(kept.select(*keys), list(keys), "left_anti")


def reclassified(table: DataFrame, supported: DataFrame, keys: Sequence[str], statement: str) -> DataFrame:
    """Rows unsupported under their own statement whose key is supported under another."""
    alone = table.join(supported.select(*keys, statement), [*keys, statement], "left_anti")
    return alone.join(supported.select(*keys).distinct(), list(keys), "left_semi")


def aggregate_else_sum(df: DataFrame, keys: Sequence[str], tag: str, value: str, total: str, parts: Sequence[str]) -> DataFrame:
    """The aggregate tag's value where reported, else the sum of its components."""
    return df.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col(tag) == total, F.col(value))), F.sum(F.when(F.col(tag).isin(*parts), F.col(value)))).alias(value))


def first_available(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Rows of the best-ranked tag that each key has."""
    return best_priority(df, keys, priority)


def collapse_labels(df: DataFrame, supported: DataFrame, keys: Sequence[str], label: str, order: Sequence[Column]) -> DataFrame:
    """Without rows whose key is supported under another label but not their own; of what is left one row per key and label."""
    return top_n(df.join(reclassified(df, supported, keys, label).select(*keys, label).distinct(), [*keys, label], "left_anti"), [*keys, label], order)


def prefer_implied(flows: DataFrame, ends: DataFrame, keys: Sequence[str], date: str, year: str, end: str) -> DataFrame:
    """Of flow rows of one key and date the one whose year is the one that the date implies, else the least year; dates must be unique after.

    ``ends`` has the keys' first column, the year and its end. Rows without a date stay as they are.
    """
    from ledgerspark.operators.asof import implied_period

    known = implied_period(flows.filter(F.col(date).isNotNull()), ends, [keys[0]], date, end, year, "__implied")
    one = top_n(known, [*keys, date], [F.col(year).eqNullSafe(F.col("__implied")).desc(), F.asc_nulls_last(year)])
    return one.drop("__implied").unionByName(flows.filter(F.col(date).isNull()))


def apply_mapping(facts: DataFrame, decisions: DataFrame, concept: str = "source_concept") -> DataFrame:
    """``facts`` with ``canonical`` by a table of decisions (source_concept, canonical_concept, status, notes): only accepted ones give a name.

    A decision without notes is an error. The table is configuration, so Catalyst may broadcast it by its size.
    """
    if decisions.filter("notes IS NULL OR notes = ''").limit(1).count():
        raise ValueError("a mapping decision needs notes")
    usable = decisions.filter("status = 'accepted'").select(F.col("source_concept").alias(concept), F.col("canonical_concept").alias("canonical"))
    return facts.join(usable, concept, "left")


def implausible_neighbours(df: DataFrame, keys: Sequence[str], order: str, value: str, factor: float = 500.0, rounds: int = 15) -> DataFrame:
    """``df`` with ``suspect``: values a factor away from the nearest trusted value before them, or else after them.

    A suspect is trusted by nobody in the next round, in which all are judged anew. Where rounds end unsettled, only what
    was suspect twice in a row stays so. Rounds write keys, order, value and flags alone; a count and a checksum per round
    are all that reaches the driver.
    """
    from ledgerspark.operators.windows import nearest
    from ledgerspark.session import discard, materialize

    whole = materialize(df.withColumn("__id", F.monotonically_increasing_id()), "plausibility-rows")
    state, seen = whole.select("__id", *keys, order, value, F.lit(False).alias("suspect"), F.lit(False).alias("__was")), None
    for _ in range(rounds):
        earlier, later = nearest(F.when(~F.col("suspect"), F.col(value)), keys, order)
        near = state.withColumn("__near", F.coalesce(earlier, later)).withColumn("__was", F.col("suspect"))
        ratio = F.when((F.col("__near") != 0) & (F.col(value) != 0), F.col(value) / F.col("__near"))
        state = near.withColumn("suspect", F.coalesce((ratio >= factor) | (ratio <= 1 / factor), F.lit(False))).drop("__near")
        before, state = state, materialize(state, "plausibility")
        discard(before)
        now = state.filter("suspect").agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("__id")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    return whole.join(state.select("__id", (F.col("suspect") & F.col("__was")).alias("suspect")), "__id").drop("__id")
