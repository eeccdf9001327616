"""Connected components of an edge list, by alternating large and small stars (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.session import discard, materialize


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of an edge list of longs; root is the smallest node of the component.

    Loops, nulls and repeated edges are ignored. Each round hangs larger neighbours, then smaller ones, on the
    smallest node seen; rounds needed grow as the logarithm of the longest chain (an error after ``most_rounds``). Every
    round is written to shared storage, so a lost executor never replays earlier rounds; files of rounds that are done with
    go. The least neighbours are written, too: then a node with very many neighbours is a skewed join that Spark can split.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    e = materialize(e, "edges")
    state = _state(e)
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct(), "small-star")
        discard(before, smallest, large)
        after = _state(e)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    """Count and order-free checksum of an edge list."""
    return tuple(e.select(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
