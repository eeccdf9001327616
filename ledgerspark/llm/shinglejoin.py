"""N-gram Jaccard join: which texts share 5-word shingles to the threshold, as connected components.

Texts with equal shingle sets are one node from the start. Any pair that meets the threshold shares one of
the first shingles of both in a global order (common shingles last, from a histogram over all texts, else by hash);
these postings are dealt out in tiles by shingle, those of very common shingles salted.

* A small tile gives its pairs that pass the size and position filters, a bounded number per posting.
* A large tile is split by size bands and then into blocks of bounded size. In a block a breadth-first search tells which
  nodes hang together by pairs whose bit counts do not rule them out: hashed parity bitmaps differ in a bit only if one
  side has a shingle that the other lacks, which bounds the overlap from above.

What hangs together is a cluster, mostly a group of near copies. Its texts meet in blocks of bounded size, each of
which is searched breadth-first by exact intersection of sorted arrays of shingle hashes.

Blocks are drawn by hash, so those of different tiles (of a cluster: two ways of drawing) overlap, and nearly all that
belongs together is joined without pairs of blocks. What is left is compared exactly in a second round (``_rest``): in each
tile or cluster of several blocks, all nodes outside its largest class meet every block. So no pair is left out, while a
group of m near copies costs rows in proportion to m, not to m * m. Only a spanning forest of links is put out.
Shingles and nodes are named by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick
from ledgerspark.llm.bytescan import LOWER, SPACED, Chunk, Words, chunks, find_words, mix, word_hashes
from ledgerspark.llm.components import connected_components
from ledgerspark.session import discard, materialize, ship_package


@dataclass(frozen=True)
class JoinConfig:
    """No result depends on the fields after ``percent``.

    ``bucket_bits``: buckets of the histogram; ``hot_from``: occurrences from which a bucket's shingles are salted (if also
    ``hot_times`` the mean); ``small_tile``: postings up to which a tile gives pairs; ``block_rows, block_items``: bounds of a block.
    """

    words: int = 5
    percent: int = 80
    bucket_bits: int = 18
    hot_from: int = 1 << 20
    hot_times: int = 8
    salts: int = 256
    small_tile: int = 4
    block_rows: int = 256
    block_items: int = 200_000

    def needed(self, n: np.ndarray | int) -> np.ndarray | int:
        """Least overlap of a set of n with a set that is not smaller, or with any set it links with."""
        return -(-self.percent * n // 100)

    def needed_as_smaller(self, n):
        return -(-2 * self.percent * n // (100 + self.percent))

    def needed_by(self, both):
        """Least overlap of two sets whose sizes add up to ``both``."""
        return -(-self.percent * both // (100 + self.percent))

    def linked(self, shared, both):
        return 100 * shared >= self.percent * (both - shared)


def _windows(chunk: Chunk, width: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a chunk, their hashes, and the hash of the ``width`` words from each on, if that many follow in the chunk."""
    data = LOWER[chunk.data]
    words = find_words(chunk, data, SPACED)
    h = word_hashes(data, words)
    m = max(0, len(h) - width + 1)
    full = np.zeros(m, np.uint64)
    for k in range(width):
        full *= np.uint64(0x9FB21C651E98DF25)
        full += h[k : k + m]
    return words, h, mix(full)


def shingle_sets(chunk: Chunk, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles."""
    words, h, full = _windows(chunk, width)
    for r in range(chunk.rows):
        lo, hi = words.first[r], words.first[r + 1]
        if hi - lo >= width:
            yield np.unique(full[lo : hi - width + 1])
        elif hi > lo:
            short = np.uint64(hi - lo)
            for x in h[lo:hi]:
                short = np.uint64((int(short) * 0xC2B2AE3D27D4EB4F + int(x)) & (1 << 64) - 1)
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def name(items: np.ndarray) -> int | None:
    """A 64-bit name of a set; none for the empty one."""
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True) if len(items) else None


def bitmap(items: np.ndarray) -> bytes:
    """Parity bitmap: bit h mod 2**k of each hash flipped, with about one bit per item, 64 to 8192 bits."""
    k = min(13, max(6, int(len(items)).bit_length()))
    bits = np.bincount((items & np.uint64((1 << k) - 1)).astype(np.int64), minlength=1 << k) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, both: int) -> int:
    """An upper bound of the overlap of two sets from their bitmaps; ``both``: sizes added up."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # bits are taken modulo a power of two, so halves fold by xor
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return (both - int(np.bitwise_count(x ^ y).sum())) // 2


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Exact size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


HOT = 128


def shingle_classes(docs: DataFrame, config: JoinConfig) -> np.ndarray:
    """How common the shingles of each bucket of hashes are, over all texts: half steps of log2 over the mean bucket; from HOT on, salted."""
    shift = np.uint64(64 - config.bucket_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << config.bucket_bits, np.int64)
        for batch in batches:
            for chunk in chunks(pick(batch, "text")):
                words, _, full = _windows(chunk, config.words)
                inside = words.row[: len(full)] == words.row[config.words - 1 :]
                total += np.bincount((full[inside] >> shift).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    ship_package(docs.sparkSession)
    found = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << config.bucket_bits)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    mean = max(1.0, counts.mean())
    classes = np.minimum(2 * np.log2(np.maximum(counts / mean, 1)), HOT - 1).astype(np.uint8)
    classes[counts >= max(config.hot_from, config.hot_times * mean)] += HOT
    return classes


def _sets(docs: DataFrame, classes: np.ndarray, config: JoinConfig) -> DataFrame:
    """``id, key, n, node, bits, head, cold``: of each row its set's size, name, bitmap and prefix, and how many of that are not to be salted."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    shift = np.uint64(64 - config.bucket_bits)
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("head", longs), T.StructField("cold", T.IntegerType())]

    def compute(batch: pa.RecordBatch) -> list:
        known = shared.value
        out: list[list] = [[] for _ in fields]
        for chunk in chunks(pick(batch, "text")):
            for items in shingle_sets(chunk, config.words):
                n = len(items)
                if not n:
                    row = (0, None, b"", [], 0)
                else:
                    length = n - int(config.needed(n)) + 1
                    kind = known[(items >> shift).astype(np.int64)]
                    first = np.argsort(kind, kind="stable")[:length]
                    row = (n, name(items), bitmap(items), items[first].view(np.int64), int((kind[first] < HOT).sum()))
                for column, x in zip(out, row, strict=True):
                    column.append(x)
        return out

    return append(docs, fields, compute).drop("text")


def tile_pairs(tile: np.ndarray, n: np.ndarray, place: np.ndarray, node: np.ndarray, config: JoinConfig) -> np.ndarray:
    """Candidate pairs (2 columns, smaller node first) of postings sorted by tile and size; ``tile`` numbers the tiles."""
    found, d, i = [], 1, np.arange(max(0, len(tile) - 1))
    while len(i):
        j = i + d
        alive = tile[i] == tile[j]
        alive &= n[i] >= config.needed(n[j])  # sorted by size: once too small, too small for all further ones
        i, j = i[alive], j[alive]
        ok = _possible(n[i], place[i], n[j], place[j], config)
        found.append(np.sort(np.stack([node[i[ok]], node[j[ok]]], 1), 1))
        d += 1
        i = i[i + d < len(tile)]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _possible(n, place, n_more, place_more, config: JoinConfig):
    """Whether a shingle at these places can be the first that a set and one that is not smaller share."""
    ok = place <= n - config.needed_as_smaller(n)
    return ok & (np.minimum(n - place, n_more - place_more) >= config.needed_by(n + n_more))


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [pick(batch, x).to_numpy(zero_copy_only=False) for x in names]


def _runs(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))


def _cells(batches: Iterator[pa.RecordBatch], read: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Columns of each cell, from batches sorted by it; ``read`` gives a batch's columns, the cell first."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        c = read(batch)
        if not len(c[0]):
            continue
        edge = _runs(c[0])
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            part = [x[lo:hi] for x in c]
            if held and held[-1][0][-1] != part[0][0]:
                yield [np.concatenate(x) for x in zip(*held, strict=True)]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _tiles(nodes: DataFrame, config: JoinConfig) -> DataFrame:
    """``a, b, tile, block, n, place``: candidate pairs of small tiles (tile null), postings of large ones (b null).

    A large tile's postings go to the tile of their size band, and to the one below if a link may reach there; a tile's
    postings come in an order by hash and are cut into blocks as they pass, so that no tile is ever held as a whole.
    Postings of a common shingle are dealt out by a salt as well; each salt has blocks of its own.
    """
    posted = nodes.select("node", "cold", F.shiftleft("n", 32).alias("size"), F.posexplode("head").alias("place", "token"))
    salt = F.when(F.col("place") >= F.col("cold"), F.pmod(F.xxhash64("token", "node"), F.lit(config.salts))).otherwise(F.lit(-1)).cast("int")
    posted = posted.select("token", salt.alias("salt"), F.col("size").bitwiseOR(F.col("place")).alias("np"), "node")
    dealt = posted.repartition("token", "salt").sortWithinPartitions("token", "salt", F.xxhash64("node", "token"))
    names = ["a", "b", "tile", "block", "n", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, running, passed = None, None, {}
        for batch in batches:
            c = _columns(batch, ["token", "salt", "np", "node"])
            if held is not None:
                c = [np.concatenate(x) for x in zip(held, c, strict=True)]
                held = None
            if not len(c[0]):
                continue
            edge = _runs(c[0] ^ (c[1].astype(np.int64) + 1 << 48))
            if edge[-1] - edge[-2] <= config.small_tile and (c[0][-1], c[1][-1]) != running:
                cut = int(edge[-2])  # what may be a small tile waits for its end
                held = [x[cut:] for x in c]
                c, edge = [x[:cut] for x in c], edge[:-1]
                if not cut:
                    continue
            yield from emit(c, edge, running, passed)
            last = (c[0][-1], c[1][-1])
            if last != running:
                running = last if held is None else None
                passed.clear()
                if running is not None:
                    count_on(c, int(edge[-2]), passed)
            else:
                count_on(c, int(edge[-2]), passed)
        if held is not None:
            yield from emit(held, _runs(held[0] ^ (held[1].astype(np.int64) + 1 << 48)), None, {})

    def bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.frexp(n.astype(float))[1], np.frexp(config.needed(n).astype(float))[1]

    def count_on(c: list[np.ndarray], lo: int, passed: dict[int, int]) -> None:
        band, lower = bands(c[2][lo:] >> 32)
        for b, k in zip(*np.unique(np.concatenate([band, lower[lower < band]]), return_counts=True), strict=True):
            passed[int(b)] = passed.get(int(b), 0) + int(k)

    def emit(c: list[np.ndarray], edge: np.ndarray, running: tuple | None, passed: dict[int, int]) -> Iterator[pa.RecordBatch]:
        token, salt, packed, node = c
        n, place = packed >> 32, packed & 0xFFFFFFFF
        df = np.diff(edge)
        goes_on = running is not None and (token[0], salt[0]) == running
        is_small = (df <= config.small_tile) & (salt[edge[:-1]] < 0)
        if goes_on:
            is_small[0] = False
        number = np.repeat(np.arange(len(df)), df)
        small = np.flatnonzero(np.repeat(is_small & (df > 1), df))
        small = small[np.lexsort((node[small], n[small], number[small]))]
        pairs = tile_pairs(number[small], n[small], place[small], node[small], config)
        if len(pairs):
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, none, none], names)
        large = np.flatnonzero(np.repeat(~is_small, df))
        if len(large):
            band, lower = bands(n[large])
            two = np.flatnonzero(lower < band)
            at, band = np.concatenate([large, large[two]]), np.concatenate([band, lower[two]])
            order = np.lexsort((at, band, number[at]))
            at, band = at[order], band[order]
            starts = _runs(number[at] * 64 + band)
            size = np.diff(starts)
            offset = np.zeros(len(size), np.int64)
            if goes_on:
                for k in np.flatnonzero(number[at[starts[:-1]]] == 0):
                    offset[k] = passed.get(int(band[starts[k]]), 0)
            index = np.arange(len(at)) - np.repeat(starts[:-1] - offset, size)
            block = index // config.block_rows + (np.maximum(salt[at], 0).astype(np.int64) << 32)
            tile = mix(token[at].view(np.uint64) ^ band.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.nulls(len(at), pa.int64()), pa.array(tile), pa.array(block), pa.array(n[at]), pa.array(place[at])], names)

    return dealt.mapInArrow(run, "a long, b long, tile long, block long, n long, place long")


def search(count: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of the graph on 0 to count - 1; ``linked(x, others)`` tells which others x is linked to."""
    left, edges = np.arange(count), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = linked(x, left)
            queue += left[hit].tolist()
            edges += [(x, int(y)) for y in left[hit]]
            left = left[~hit]
    return edges


def _meet(side: np.ndarray, root: np.ndarray, linked) -> list[tuple[int, int]]:
    """Links between rows of side 1 and rows of other classes on side 0: one for each class that a row is linked to."""
    edges, others = [], np.flatnonzero(side == 0)
    for x in np.flatnonzero(side == 1):
        far = others[root[others] != root[x]]
        far = far[linked(int(x), far)] if len(far) else far
        edges += [(int(x), int(far[k])) for k in np.unique(root[far], return_index=True)[1]]
    return edges


def _edges(dealt: DataFrame, read, linker, second: bool) -> DataFrame:
    """``a, b`` (their classes in the second round): the links found in each cell of ``dealt``; ``read`` begins with cell, node, side, root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, side, root, *rest in _cells(batches, read):
            if len(node) < 2:
                continue
            linked = linker(*rest)
            found = _meet(side, root, linked) if second else search(len(node), linked)
            if found:
                x, y = np.array(found).T
                ends = root if second else node
                yield pa.RecordBatch.from_arrays([pa.array(ends[x], pa.int64()), pa.array(ends[y], pa.int64())], ["a", "b"])

    placed = dealt.repartition("cell").sortWithinPartitions("cell")
    return placed.mapInArrow(run, "a long, b long")


def _rest(rows: DataFrame, config: JoinConfig) -> DataFrame:
    """Cells of the second round, from ``group, block, node, root``: each node outside its group's largest class meets all blocks.

    Such nodes are dealt out in chunks, so that a cell holds one block and one chunk: ``cell, side`` (1: of the chunk).
    Groups of one class give none.
    """
    classes = rows.groupBy("group", "root").agg(F.count_distinct("node").alias("size"))
    most = classes.groupBy("group").agg(F.max(F.struct("size", "root")).alias("major"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    most = most.select("group", F.col("major.root").alias("major"), F.ceil((F.col("all") - F.col("major.size")) / config.block_rows).cast("long").alias("chunks"))
    many = rows.join(most, "group")
    minor = many.filter("root <> major").select("group", "node", "root", F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks")).alias("chunk"), *_carried(rows)).dropDuplicates(["group", "node"])
    near = minor.join(many.select("group", "block").distinct(), "group").withColumn("side", F.lit(1).cast("long"))
    far = many.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).withColumn("side", F.lit(0).cast("long"))
    columns = [F.xxhash64("group", "block", "chunk").alias("cell"), "node", "side", "root", *_carried(rows)]
    return near.select(columns).unionByName(far.select(columns))


def _carried(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("group", "block", "node", "root")]


def _first(cell: Column) -> list[Column]:
    """Columns of the first round."""
    return [cell.alias("cell"), F.col("node"), F.lit(0).cast("long").alias("side"), F.lit(0).cast("long").alias("root")]


def _read_tiles(batch: pa.RecordBatch) -> list[np.ndarray]:
    return _columns(batch, ["cell", "node", "side", "root", "n", "place", "bits"])


def _bit_linker(config: JoinConfig):
    """Which pairs of a tile are not ruled out by size, position and bit counts."""

    def linker(size: np.ndarray, at: np.ndarray, bits: np.ndarray):
        width = max(1, min(map(len, bits)) // 8)
        maps = np.stack([_folded(x, width) for x in bits])

        def linked(x: int, others: np.ndarray) -> np.ndarray:
            m = size[others]
            less, more = np.minimum(size[x], m), np.maximum(size[x], m)
            low = np.where(m < size[x], at[others], at[x])
            high = np.where(m < size[x], at[x], at[others])
            ok = (less >= config.needed(more)) & _possible(less, low, more, high, config)
            differ = np.bitwise_count(maps[others] ^ maps[x]).sum(1)
            return ok & ((size[x] + m - differ) // 2 >= config.needed_by(size[x] + m))

        return linked

    return linker


def _folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap as ``width`` words of 64 bits, folded by xor."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) > width:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _likely(pairs: DataFrame, nodes: DataFrame, config: JoinConfig) -> DataFrame:
    """The candidate pairs that the bit counts do not rule out."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))

    def by_bits(batch: pa.RecordBatch) -> list:
        columns = [pick(batch, c).to_pylist() for c in ("xa", "xb", "na", "nb")]
        return [[overlap_bound(x, y, m + n) >= config.needed_by(m + n) for x, y, m, n in zip(*columns, strict=True)]]

    return append(pairs.join(left, "a").join(right, "b"), [T.StructField("ok", T.BooleanType())], by_bits).filter("ok").select("a", "b")


def _merged(classes: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``classes`` (``node, root``) after links between roots. Nothing is joined where no link was found."""
    links = materialize(links.distinct(), f"{label}-links")
    if links.isEmpty():
        return materialize(classes, label)
    roots = connected_components(links).select(F.col("node").alias("root"), F.col("root").alias("least"))
    return materialize(classes.join(roots, "root", "left").select("node", F.coalesce("least", "root").alias("root")), f"{label}-merged")


def _clusters(tiles: DataFrame, nodes: DataFrame, config: JoinConfig) -> DataFrame:
    """``node, root``: what hangs together by pairs that sizes, positions and bit counts do not rule out."""
    likely = _likely(tiles.filter("tile IS NULL").select("a", "b").distinct(), nodes, config)
    large = tiles.filter("tile IS NOT NULL").select(F.col("tile").alias("group"), "block", F.col("a").alias("node"), "n", "place")
    bits = nodes.select("node", "bits")
    first = large.join(bits, "node").select(*_first(F.xxhash64("group", "block")), "n", "place", "bits")
    found = _edges(first, _read_tiles, _bit_linker(config), False)
    classes = materialize(connected_components(likely.unionByName(found)), "join-clusters")
    several = materialize(large.filter("block > 0").select("group").distinct(), "join-several")
    if several.isEmpty():
        return classes
    rows = large.join(several, "group", "left_semi").join(classes, "node", "left")
    rows = materialize(rows.withColumn("known", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "node")), "join-wide")
    alone = rows.filter("NOT known").select("node", "root").distinct()
    second = _rest(rows.drop("known"), config).join(bits, "node")
    merged = _merged(classes.unionByName(alone), _edges(second, _read_tiles, _bit_linker(config), True), "join-wide")
    discard(several, rows)
    return merged


def _read_texts(config: JoinConfig, *more: str) -> Callable[[pa.RecordBatch], list[np.ndarray]]:
    """Reader of rows with a text; its set comes last."""

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        sets = np.empty(batch.num_rows, object)
        k = 0
        for chunk in chunks(pick(batch, "text")):
            for items in shingle_sets(chunk, config.words):
                sets[k] = items
                k += 1
        return [*_columns(batch, ["cell", "node", "side", "root", *more]), sets]

    return read


def _linker(config: JoinConfig):
    """Which pairs meet the threshold, by exact intersection of their sets."""

    def linker(sets: np.ndarray):
        size = np.array([len(x) for x in sets])
        known, flat = np.unique(np.concatenate(list(sets)), return_inverse=True)
        ends = np.cumsum(size)
        mark = np.zeros(len(known), bool)

        def linked(x: int, others: np.ndarray) -> np.ndarray:
            fits = np.flatnonzero(np.minimum(size[others], size[x]) >= config.needed(np.maximum(size[others], size[x])))
            hit = np.zeros(len(others), bool)
            if len(fits):
                m = size[others[fits]]
                begin = np.cumsum(m) - m
                place = np.arange(int(m.sum())) - np.repeat(begin - (ends[others[fits]] - m), m)
                own = flat[ends[x] - size[x] : ends[x]]
                mark[own] = True
                shared = np.add.reduceat(mark[flat[place]], begin, dtype=np.int64)
                mark[own] = False
                hit[fits] = config.linked(shared, size[x] + m)
            return hit

        return linked

    return linker


def _blocks(clusters: DataFrame, config: JoinConfig) -> DataFrame:
    """``clusters`` (with ``node, n, root``) with ``blocks``: into how many its cluster is cut.

    Only clusters of several blocks are joined back, as a written table, so that Spark can split the join of a large one.
    """
    total = clusters.groupBy("root").agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.greatest(F.col("items") / config.block_items, F.col("size") / config.block_rows)).cast("long")
    large = materialize(total.select("root", blocks.alias("__blocks")).filter("__blocks > 1"), "join-large")
    return clusters.join(large, "root", "left").withColumn("blocks", F.coalesce("__blocks", F.lit(1).cast("long"))).drop("__blocks")


def _block(way: int) -> Column:
    """A node's block in one of the ways of cutting its cluster."""
    return F.pmod(F.xxhash64("node", F.lit(way)), F.col("blocks"))


def _links(clusters: DataFrame, texts: DataFrame, config: JoinConfig) -> DataFrame:
    """``node, root``: components of the true links; ``clusters`` has ``node, key, n, root``, ``texts`` a text per key.

    The texts of clusters are written once, so that the second round reads only those it needs.
    """
    cut = materialize(_blocks(clusters, config).join(texts, "key").drop("key"), "join-texts")
    once = cut.select(*_first(F.xxhash64("root", _block(0))), "text")
    again = cut.filter("blocks > 1").select(*_first(F.xxhash64("root", _block(1), F.lit(1))), "text")
    found = _edges(once.unionByName(again), _read_texts(config), _linker(config), False)
    classes = materialize(connected_components(found), "join-found")
    wide = cut.filter("blocks > 1").select(F.col("root").alias("group"), _block(0).alias("block"), "node")
    if wide.isEmpty():
        discard(cut)
        return classes
    rows = wide.join(classes, "node", "left")
    rows = materialize(rows.withColumn("known", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "node")), "join-wide")
    alone = rows.filter("NOT known").select("node", "root")
    left = materialize(_rest(rows.drop("known"), config), "join-rest")
    own = cut.filter("blocks > 1").select("node", "text")
    merged = _merged(classes.unionByName(alone), _edges(left.join(own, "node"), _read_texts(config), _linker(config), True), "join-found")
    discard(cut, rows, left, classes)
    return merged


def _keyed(id_col: str, text_col: str):
    """A 64-bit key of an id and a text; rows with the same of both are alike to the join."""
    return F.xxhash64(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def _texts(docs: DataFrame) -> DataFrame:
    """A text per key; repeated rows are dropped before anything is shuffled."""
    return docs.groupBy("key").agg(F.first("text").alias("text"))


def _classes(docs: DataFrame, config: JoinConfig) -> tuple[DataFrame, DataFrame]:
    """``id, key, n, node`` of each row of ``id, key, text``, and ``node, key, root, rep``: the component of each node, and its smallest id.

    A node is read from the row with its smallest key, so that nodes whose rows all have null ids (``rep`` null) are linked, too.
    """
    sets = materialize(_sets(docs, shingle_classes(docs, config), config), "join-sets")
    one = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("n", "bits", "head", "cold")])
    one = materialize(one, "join-nodes")
    tiles = materialize(_tiles(one, config), "join-tiles")
    clusters = _clusters(tiles, one, config)
    discard(tiles)
    roots = _links(clusters.join(one.select("node", "key", "n"), "node"), _texts(docs), config)
    placed = materialize(one.select("node", "key", "rep").join(roots, "node", "left").select("node", "key", "rep", F.coalesce("root", "node").alias("root")), "join-placed")
    discard(one, clusters)
    return sets.select("id", "key", "n", "node"), placed


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), _keyed(id_col, text_col).alias("key"))


def similar_texts(docs: DataFrame, config: JoinConfig = JoinConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id``, one row per input row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a text's set has its distinct shingles, the whole
    sequence if it has fewer words than a shingle. Texts are linked at ``100 * shared >= percent * union``;
    ``component_id`` is the smallest id reachable. A null or empty text or one without words has no shingles and
    is linked with nothing. Repeated rows and ids are kept and linked; rows with a null id link others like any, and keep a
    null component unless they are linked with a row that has an id. Other columns are ignored; an empty table gives an empty one.
    """
    sets, placed = _classes(_rows(docs, id_col, text_col), config)
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component"))
    classes = placed.join(smallest, "root").select("node", "component")
    found = sets.select("id", "n", "node").join(classes, "node", "left")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_one(docs: DataFrame, config: JoinConfig = JoinConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of linked texts: one with the smallest id (null after all others), of its texts any, but always the same.

    Texts without a word are linked with nothing; their rows stay, repeated ones with an id once. Of rows that agree in id and
    text any one stands for all.
    """
    sets, placed = _classes(_rows(docs, id_col, text_col), config)
    best = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "key")).alias("best")
    first = sets.filter("node IS NOT NULL").join(placed.select("node", "root"), "node").groupBy("root").agg(best).select("best.key")
    first = first.unionByName(sets.filter("node IS NULL AND id IS NOT NULL").select("key").distinct())
    wordless = F.col(f"`{id_col}`").isNull() & ~F.coalesce(F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    once = docs.filter(~wordless).select(row, _keyed(id_col, text_col).alias("key")).dropDuplicates(["key"])
    return once.join(first, "key", "left_semi").select("row.*").unionByName(docs.filter(wordless))


def count_links(docs: DataFrame, config: JoinConfig = JoinConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_links``, one row per input row: with how many other rows its text is linked, by threshold, not by reach.

    Every pair of a component is compared exactly, none is left out, so time grows with the square of a component's distinct
    sets; cells hold two blocks of bounded size, and what is put out is one sum per node and cell.
    """
    docs = _rows(docs, id_col, text_col)
    sets, placed = _classes(docs, config)
    copies = sets.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    cut = _blocks(placed.select("node", "key", "root").join(copies, "node"), config)
    own = _block(0)
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    side = F.when(F.col("t.i") != F.col("t.j"), (own == F.col("t.j")).cast("long")).otherwise(F.lit(-1).cast("long"))
    dealt = cut.withColumn("t", F.explode(others)).select("node", "key", "copies", "root", side.alias("side"), F.xxhash64("root", "t.i", "t.j").alias("cell"))
    dealt = dealt.join(_texts(docs), "key").drop("key").repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, half, _, copied, texts in _cells(batches, _read_texts(config, "copies")):
            total = np.zeros(len(node), np.int64)
            linked, far = _linker(config)(texts), np.flatnonzero(half == 1)
            for x in np.flatnonzero(half != 1):
                others = np.arange(x + 1, len(node)) if half[x] < 0 else far
                others = others[linked(int(x), others)]
                total[x] += copied[others].sum()
                total[others] += copied[x]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(total, pa.int64())], ["node", "more"])

    more = dealt.mapInArrow(run, "node long, more long").groupBy("node").agg(F.sum("more").alias("more"))
    counts = copies.join(more, "node", "left").select("node", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return sets.select("id", "node").join(counts, "node", "left").select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
