"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Each document has a fixed 48-bit hash of its id. A source whose target is ``c`` whole copies and a fraction
``f`` of its size takes ``c`` copies of every document and one more of those below a hash threshold. The
threshold is found from histograms of tokens by source and hash bucket: the bucket in which the budget runs
out is the boundary, and only that bucket's documents are counted again in finer buckets. Nothing is sorted,
and a larger budget always keeps what a smaller one took, so that budgets nest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.session import materialize

LEVELS, BITS = 4, 12


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_hash(key: Column) -> Column:
    """48 bits of the md5 of an id's text; a null id hashes like an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """``source, source_size`` -> with ``target``: shares by weight, none above ``most`` times its size.

    Weights repeat over the sources in code point order, null last. Sources are filled in the order of the
    level at which they are full, so the excess of the full ones is shared by the others in one pass of
    window sums over one row per source (in one task: sources are taken to number millions at most).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("full_at", "rank")
    everything = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    level = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") - 1) % len(weights) + 1)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    level = level.withColumn("full_at", F.col("cap") / F.col("weight")).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    full_before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = level.withColumn("level", (F.col("total") - full_before) / weight_left)
    level = level.withColumn("open_level", F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(everything))
    target = F.least("cap", F.coalesce(F.col("open_level") * F.col("weight"), F.col("cap")))
    return level.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The sizes ``doc_id, source, size, h`` of all rows, and ``s, source_size, target, whole, threshold`` per source."""
    ident, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`")
    narrow = docs.select(ident.alias("doc_id"), source.alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"), id_hash(ident).alias("h"))
    sized = materialize(narrow, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("whole", whole).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    edge = plan.select("source", "source_size", "target", "whole", "left", F.lit(0).cast("long").alias("prefix"), F.lit(False).alias("over"))
    edge = materialize(edge, "mix-plan")
    for level in range(LEVELS):
        edge = materialize(_refine(sized, edge, level), f"mix-level{level}")
    threshold = F.when(F.col("target") > F.col("whole") * F.col("source_size"), F.col("prefix") + F.col("over").cast("long")).otherwise(F.lit(0))
    return sized, edge.select(F.col("source").alias("s"), "source_size", "target", "whole", threshold.cast("long").alias("threshold"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, one row per input row.

    ``copies`` is how often the mix takes the document, ``taken = copies * size``. A null text has size 0, a
    null source is a source of its own, a null id hashes like an empty one. Rows with equal ids are taken
    alike. A source whose target is a whole number of copies takes just those, of empty texts, too. A source without words has target 0 and takes nothing. Other columns are ignored; an empty table
    gives an empty one. A source's taken words miss its target by half of one document (all rows of one id) at most.
    """
    sized, plan = mix_plan(docs, weights, most, id_col, text_col, source_col)
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("s")), "left")
    copies = F.col("whole") + (F.col("h") < F.col("threshold")).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, at most ``most`` times. Only the plan meets the texts.

    Nulls, ties and repeated rows as in ``mix_sources``; all columns are kept as they are, whatever their names.
    """
    _, plan = mix_plan(docs, weights, most, id_col, text_col, source_col)
    plan = plan.select(F.struct("s", "whole", "threshold").alias("plan"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    copies = F.col("plan.whole") + (id_hash(F.col(f"row.`{id_col}`")) < F.col("plan.threshold")).cast("long")
    joined = rows.join(plan, F.col(f"row.`{source_col}`").eqNullSafe(F.col("plan.s"))).withColumn("copies", copies.cast("int")).filter("copies > 0")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def _refine(sized: DataFrame, edge: DataFrame, level: int) -> DataFrame:
    """The next BITS bits of each source's threshold, from the documents of its boundary bucket alone."""
    shift = BITS * (LEVELS - 1 - level)
    e = edge.select(F.col("source").alias("s"), F.col("prefix").alias("p"))
    bucket = F.shiftright("h", shift)
    inside = sized.join(e, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + BITS) == F.col("p")))
    histogram = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("tokens"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = histogram.withColumn("upto", F.sum("tokens").over(running)).select(F.col("source").alias("s"), "bucket", "tokens", "upto")
    crossing = edge.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("upto") > F.col("left")), "left")
    first = crossing.groupBy("source", "source_size", "target", "whole", "left", "prefix").agg(F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "tokens", "upto"))).alias("b"))
    left = F.col("left") - (F.col("b.upto") - F.col("b.tokens"))
    found = F.col("b").isNotNull()
    nearer = found & (F.col("b.upto") - F.col("left") < left)
    prefix = F.coalesce(F.col("b.bucket"), F.shiftleft("prefix", BITS))
    return first.select("source", "source_size", "target", "whole", F.when(found, left).otherwise(F.col("left")).alias("left"), prefix.alias("prefix"), F.coalesce(nearer, F.lit(False)).alias("over"))
