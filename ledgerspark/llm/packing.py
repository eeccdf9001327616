"""Best-fit packing into sequences of several permitted lengths.

Pieces (documents, cut where they exceed the greatest length) are dealt out by hash to shards of bounded
size, and each shard is packed by itself: longest piece first, into the open bin with the least room that
still suffices. If none does, a bin is opened, of the size whose cost per token is least among those that a
policy permits. The lengths are chosen jointly: every set of lengths that may be opened (with the greatest
among them), by least cost per token or by the tightest fit, is a policy, and what each has packed is improved by joining bins wherever one permitted length holds two of
them at less cost. The cheapest packing is kept, in which a bin counts at the least permitted size that holds its contents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.mixing import word_count
from ledgerspark.session import materialize, ship_package


@dataclass(frozen=True)
class PackConfig:
    """lengths: permitted sequence lengths; a sequence of n tokens costs ``fixed + n + n * n / quadratic``."""

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096)
    fixed: float = 64.0
    quadratic: float = 16384.0
    rows_per_shard: int = 40_000

    def cost(self, n: int) -> float:
        return self.fixed + n + n * n / self.quadratic


def best_fit(sizes: Sequence[int], config: PackConfig, opened: Sequence[int], tight: bool = False) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece (sizes in falling order), and what each bin holds.

    Bins are opened at the length of ``opened`` whose full bin costs least per token; ``tight``: at the least that holds the piece.
    """
    open_size = [0] * (max(opened) + 1)
    for need in range(1, max(opened) + 1):
        open_size[need] = min((c for c in opened if c >= need), key=lambda c: (0 if tight else config.cost(c) / c, c))
    room: dict[int, list[int]] = {}
    mask = 0  # bit r: some bin has r tokens of room
    held: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
        else:
            own, left = len(held), open_size[size]
            held.append(0)
        bins.append(own)
        offsets.append(held[own])
        held[own] += size
        left -= size
        if left:
            room.setdefault(left, []).append(own)
            mask |= 1 << left
    return bins, offsets, held


def downsize(held: int, config: PackConfig) -> int:
    return min(c for c in config.lengths if c >= held)


def joined(held: Sequence[int], config: PackConfig) -> list[int]:
    """The bin that each bin ends up in, after joining pairs of bins while one permitted length holds both at less cost.

    For each bin in falling order of contents and each permitted length the fullest bin that still fits beside it is looked up.
    """
    best = list(range(len(held)))
    own = [[k] for k in best]
    now = list(held)
    by_size: dict[int, list[int]] = {}
    mask = 0
    for k, h in enumerate(now):
        by_size.setdefault(h, []).append(k)
        mask |= 1 << h
    cost = {h: config.cost(downsize(h, config)) for h in range(max(config.lengths) + 1)}

    def forget(k: int) -> None:
        nonlocal mask
        by_size[now[k]].remove(k)
        if not by_size[now[k]]:
            mask ^= 1 << now[k]

    for k in sorted(best, key=lambda k: -now[k]):
        while own[k]:
            gains = []
            for c in config.lengths:
                room = c - now[k]
                below = mask & ((1 << room + 1) - 1) if room > 0 else 0
                if below:
                    h = below.bit_length() - 1
                    other = next((x for x in reversed(by_size[h]) if x != k), None)
                    if other is not None:
                        gains.append((cost[now[k]] + cost[h] - config.cost(c), -c, other))
            if not gains or max(gains)[0] <= 1e-9:
                break
            other = max(gains)[2]
            forget(k)
            forget(other)
            own[k] += own[other]
            own[other] = []
            now[k] += now[other]
            by_size.setdefault(now[k], []).append(k)
            mask |= 1 << now[k]
    for k, members in enumerate(own):
        for x in members:
            best[x] = k
    return best


def pack_sizes(sizes: Sequence[int], config: PackConfig) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the final size of each bin, by the cheapest policy."""
    *lower, greatest = sorted(config.lengths)
    cheapest = None
    for tight, *chosen in product((False, True), repeat=len(lower) + 1):
        bins, _, held = best_fit(sizes, config, [*[c for c, x in zip(lower, chosen, strict=True) if not x], greatest], tight)
        into = joined(held, config)
        total = [0] * len(held)
        for k, h in enumerate(held):
            total[into[k]] += h
        cost = sum(config.cost(downsize(h, config)) for h in total if h)
        if cheapest is None or cost < cheapest[0] - 1e-9:
            cheapest = cost, [into[b] for b in bins], total
    _, bins, total = cheapest
    names: dict[int, int] = {}
    filled, offsets = [0] * len(total), []
    for b, size in zip(bins, sizes, strict=True):
        names.setdefault(b, len(names))
        offsets.append(filled[b])
        filled[b] += size
    return [names[b] for b in bins], offsets, [downsize(total[b], config) for b in names]


def pack(docs: DataFrame, config: PackConfig = PackConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, bin, offset, capacity``: where each piece of each document goes.

    Tokens are words (``[^\\x20\\x09-\\x0D]+``). A document over the greatest length is cut there into pieces, numbered
    from 0; ``start`` is a piece's first word. Each piece is in one bin, which is not filled over its capacity,
    a permitted length. A null, empty or wordless text is one piece of length 0 in no bin (nulls). Repeated rows are
    packed each; a null id is an id like any. Other columns are ignored; an empty table gives an empty one. Reruns agree.

    Rows of one id and size differ in nothing that is put out. They are counted before the shuffle and numbered after it, and
    the number goes into the shard's hash, so that many rows of one id (or none) spread over all shards.
    """
    ship_package(docs.sparkSession)
    greatest = max(config.lengths)
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), word_count(F.col(f"`{text_col}`")).alias("size"))
    sized = materialize(sized.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("rows")), "pack-sizes")
    n = sized.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    sized = sized.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    number = F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(greatest).cast("long")))
    pieces = sized.select("doc_id", "size", "copy", number.alias("piece", "start"))
    pieces = pieces.select("doc_id", "copy", F.col("piece").cast("long").alias("piece"), "start", F.least(F.col("size") - F.col("start"), F.lit(greatest)).cast("long").alias("length"))
    shards = max(1, -(-n // config.rows_per_shard))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "copy"), F.lit(shards)).cast("long")
    dealt = pieces.withColumn("shard", F.when(F.col("length") == 0, -1 - shard).otherwise(shard)).drop("copy")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        shard = int(part["shard"].iloc[0])
        if shard < 0:
            empty = pd.array([None] * len(part), "Int64")
            return part.assign(bin=empty, offset=empty, capacity=empty).drop(columns="shard")
        bins, offsets, final = pack_sizes(part["length"].tolist(), config)
        return part.assign(bin=[(shard << 32) + b for b in bins], offset=offsets, capacity=[final[b] for b in bins]).drop(columns="shard")

    kind = dict(docs.dtypes)[id_col]
    return dealt.groupBy("shard").applyInPandas(run, f"doc_id {kind}, piece long, start long, length long, bin long, offset long, capacity long")
