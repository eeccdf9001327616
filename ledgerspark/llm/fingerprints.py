"""Document fingerprints by consistent weighted sampling (DataFrame operations only).

A text is a multiset of words, split at ``[\\x20\\x09-\\x0D]+``; a word's weight is its count. For each of K samples
a word draws, from hashes of itself and the sample's number, r and c from a gamma distribution of shape 2 and
b uniform, and gets ``t = floor(ln(weight) / r + b)``, ``ln y = r (t - b)``, ``ln a = ln c - ln y - r``; the sample is
(word, t) of the least a. Two texts agree in a sample with the probability of their generalised Jaccard
similarity (sum of least weights over sum of greatest).

Texts are shuffled once, by ranges of ids, in which each row also meets the row after it; words are counted
and samples taken where the text lies, with no further shuffle of either.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.session import materialize

SAMPLES = 48
#: Samples taken per row and pass: few enough that generated methods stay small and are compiled.
TOGETHER = 4
ROWS_PER_RANGE = 512
#: Bounds the broadcast of one row per range.
MOST_RANGES = 1 << 17
ROWS_PER_PARTITION = 1024
#: The sample of a word without weight: greater than any other.
NONE = (1 << 63) - 1
_MARK_BITS = 35
_MARK = (1 << _MARK_BITS) - 1


def _uniform(h: Column, part: int) -> Column:
    """One of three uniforms in (0, 1) from a 64-bit hash."""
    return (F.shiftright(h, 21 * part).bitwiseAND(F.lit((1 << 21) - 1)) + F.lit(0.5)) / F.lit(float(1 << 21))


def _samples(term: Column, logs: list[Column], k: Column) -> list[Column]:
    """For each logarithm of a word's weight (-1: without weight) a long: ln a in the high bits, the mark of (word, t) in the low ones; NONE without weight.

    No branch guards the arithmetic, so that generated code shares r, c and b between the weights.
    """
    h, g = F.xxhash64(term, k), F.xxhash64(term, -1 - k)
    r = -F.ln(_uniform(h, 0) * _uniform(h, 1))
    ln_c = F.ln(-F.ln(_uniform(g, 0) * _uniform(g, 1)))
    b = _uniform(h, 2)
    out = []
    for w in logs:
        t = F.floor(w / r + b)
        ln_a = ln_c - r * (t - b) - r
        mark = term.bitwiseXOR(t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(_MARK))
        sample = F.shiftleft(F.floor(ln_a * F.lit(float(1 << 20))), _MARK_BITS).bitwiseOR(mark)
        out.append(F.greatest(sample, F.when(w >= 0, F.lit(-NONE)).otherwise(F.lit(NONE))))
    return out


def fingerprint(texts: DataFrame, keys: list[str], text_cols: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, fp0, fp1, ...``: an array of ``samples`` longs per text column; nulls in it mean a text without words.

    ``keys`` name a row. If ``texts`` is already partitioned by some of them, nothing is shuffled.
    """
    bodies = F.posexplode(F.array(*[F.coalesce(c, F.lit("")) for c in text_cols])).alias("which", "body")
    words = texts.select(*keys, bodies).select(*keys, "which", F.explode(F.split("body", r"[\x20\x09-\x0D]+")).alias("word"))
    hashed = words.select(*keys, "which", F.when(F.col("word") != "", F.xxhash64("word")).alias("term"))
    counts = hashed.groupBy(*keys, "term").agg(*[F.sum(F.when(F.col("which") == i, 1).otherwise(0)).alias(f"w{i}") for i in range(len(text_cols))])
    known = [F.when(F.col("term").isNull() | (F.col(f"w{i}") == 0), F.lit(-1.0)).otherwise(F.ln(F.col(f"w{i}").cast("double"))) for i in range(len(text_cols))]
    counted = counts.select(*keys, "term", *[w.alias(f"w{i}") for i, w in enumerate(known)])
    n = len(text_cols)
    split = counted.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples // TOGETHER - 1))).alias("part"))
    drawn = [x for k in range(TOGETHER) for x in _samples(F.col("term"), [F.col(f"w{i}") for i in range(n)], F.col("part") * TOGETHER + k)]
    least = split.groupBy(*keys, "part").agg(*[F.min(x).alias(f"s{j}") for j, x in enumerate(drawn)])
    marks = [F.array(*[F.when(F.col(f"s{k * n + i}") < NONE, F.col(f"s{k * n + i}").bitwiseAND(F.lit(_MARK))) for k in range(TOGETHER)]).alias(f"fp{i}") for i in range(n)]
    parts = least.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("part", *marks))).alias("parts"))
    return parts.select(*keys, *[F.flatten(F.col(f"parts.fp{i}")).alias(f"fp{i}") for i in range(n)])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree; two texts without words are alike, one is unlike any other."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x))
    return same / F.lit(float(samples))


def as_text(fp: Column) -> Column:
    """9 hexadecimal digits per sample; empty for a text without words."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 9, "0"))), "")


def _range_of(key: Column, splitters: Column, count: int) -> Column:
    """Number of the range that a key is in, by binary search: how many of the ``count`` sorted splitters are not over it."""
    steps = [1 << k for k in range(max(1, count).bit_length() - 1, -1, -1)]
    reach = lambda at, step: (at + step <= count) & (F.get(splitters, (at + step - 1).cast("int")) <= key)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(reach(at, step), at + step).otherwise(at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``range, place, id, text, next_id, next_text, extra``: rows with the one after them, by descending id.

    The row after the last is the first. Null ids come last; ties are ordered by a hash of the text, then by the text. Ids
    that are not whole numbers are ordered as strings. Rows are dealt out in ranges of about equal numbers of rows: Spark's
    range partitioner, on ids and hashes alone, gives the splitters, so that neither far ids nor many texts of one id (or of
    none) make a range large; equal rows stay together. The first row of each range is also put, as ``extra``, at the end of
    the range before it. Partitioned by ``range``; ``place`` numbers rows within it.
    """
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    kind = "bigint" if whole else "string"
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.struct(ident.isNotNull().cast("int").alias("k"), F.coalesce(ident.cast(kind), F.lit(0).cast(kind)).alias("i"), F.xxhash64(text).alias("h"))
    keys = docs.select(key.alias("key"))
    n = keys.count()
    ranges = max(1, min(MOST_RANGES, -(-n // ROWS_PER_RANGE)))
    found = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).select("key.*").collect()
    cuts = sorted((r["k"], r["i"], r["h"]) for r in found)[1:]
    if kind == "string":
        cuts.sort(key=lambda c: (c[0], c[1].encode(), c[2]))
    known = F.from_json(F.lit(json.dumps([{"k": k, "i": i, "h": h} for k, i, h in cuts])), f"array<struct<k:int,i:{kind},h:bigint>>")
    rows = docs.select(ident.alias("id"), text.alias("text"), key.alias("key")).withColumn("range", _range_of(F.col("key"), known, len(cuts)).cast("long"))
    tops = materialize(rows.groupBy("range").agg(F.max("key").alias("top")), "fingerprint-tops")
    down = Window.orderBy(F.desc("range"))
    into = F.coalesce(F.lag("range").over(down), F.min("range").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ends = tops.select("top", F.col("range").alias("own"), into.alias("into"))
    firsts = rows.join(F.broadcast(ends), (F.col("key") == F.col("top")) & (F.col("range") == F.col("own")))
    firsts = firsts.groupBy("into").agg(F.min(F.struct("text", "id")).alias("r")).select(F.col("r.id").alias("id"), F.col("r.text").alias("text"), F.col("into").alias("range"), F.lit(True).alias("extra"))
    dealt = rows.select("id", "text", "range", F.lit(False).alias("extra")).unionByName(firsts)
    dealt = dealt.repartition(max(1, min(ranges, -(-n // ROWS_PER_PARTITION))), "range")
    order = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last(F.col("id").cast(kind)), F.desc(F.xxhash64("text")), "text")
    return dealt.select("range", F.row_number().over(order).alias("place"), "id", "text", F.lead("id").over(order).alias("next_id"), F.lead("text").over(order).alias("next_text"), "extra")


def edit(text: Column, other: Column) -> Column:
    """The last half (rounded down) of a text's code points replaced by the first as many, or all, of another's."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(F.coalesce(other, F.lit("")), half))


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, a row per row.

    A null text is an empty one; a text without words has a fingerprint of empty marks ('') and is like
    another such only. Equal texts have equal fingerprints. Rows with a null id are kept, last in order; order, ties and
    repeated rows as in ``with_next``.
    Other columns are ignored; an empty table gives an empty one.
    """
    ordered = with_next(docs, id_col, text_col).withColumn("edited", edit(F.col("text"), F.col("next_text")))
    marks = fingerprint(ordered, ["range", "place"], ["text", "edited"])
    order = Window.partitionBy("range").orderBy("place")
    near = marks.withColumn("next_fp", F.lead("fp0").over(order))
    found = near.select("range", "place", as_text(F.col("fp0")).alias("fingerprint"), as_text(F.col("fp1")).alias("edited_fingerprint"), likeness(F.col("fp0"), F.col("fp1")).alias("near_edited"), likeness(F.col("fp0"), F.col("next_fp")).alias("near_next"))
    base = ordered.filter(~F.col("extra")).select("range", "place", "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    return base.join(found, ["range", "place"]).select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
