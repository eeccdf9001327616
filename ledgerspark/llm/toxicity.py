"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals score documents.

Documents are labelled, words are not, so word labels are made first: in a toxic document a word is labelled
toxic if its form, or one of its beginnings, occurs in toxic documents far more often than chance allows.
The field has two tags, hashed features of the word and its beginnings, and a transition matrix. Chains are
the words of a line, cut after ``max_chain`` words. Forward-backward runs over many chains side by side. The chance
that some word is toxic, from the marginals, is calibrated to the document label by logistic regression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick
from ledgerspark.llm.bytescan import ALNUM, Chunk, Words, chunks, find_words, fold_case, mix, word_prefix_sums

PREFIXES = (3, 4, 5, 6, 8)


@dataclass(frozen=True)
class ToxicityConfig:
    """Bounds of the fit: about ``toxic_rows`` and ``clean_rows`` labelled texts of at most ``max_chars``."""

    toxic_rows: int = 1500
    clean_rows: int = 4500
    max_chars: int = 10_000
    bits: int = 18
    max_chain: int = 64
    chance: float = 1e-6
    lift: float = 20.0
    epochs: int = 12
    rate: float = 0.5
    decay: float = 1e-6
    batch: int = 2048
    seed: int = 11


@dataclass
class ToxicityModel:
    """weights: of hashed features; moves: 2 x 2 transition scores; curve: slope and offset of the document score."""

    weights: np.ndarray
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (1.0, 0.0)
    max_chain: int = 64


def features(data: np.ndarray, words: Words, bits: int) -> np.ndarray:
    """Buckets of each word: the whole form, then its beginnings of PREFIXES bytes (the form's own bucket if shorter)."""
    c = word_prefix_sums(data, words)
    size = words.end - words.start
    whole = mix((c[words.end] - c[words.start]) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
    out = np.empty((len(size), 1 + len(PREFIXES)), np.int64)
    out[:, 0] = whole
    for k, n in enumerate(PREFIXES, 1):
        long = size > n
        at = np.where(long, words.start + n, words.end)
        head = mix((c[at] - c[words.start]) + np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - bits)
        out[:, k] = np.where(long, head, whole)
    return out


def _chains(chunk: Chunk, words: Words, max_chain: int) -> np.ndarray:
    """First word of each chain, with the number of words at the end."""
    line = np.searchsorted(np.flatnonzero(chunk.data == 0x0A), words.start)
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (words.row[1:] != words.row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(line)))
    pieces = -(-size // max_chain)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.append(np.repeat(first, pieces) + inner * max_chain, len(line))


def forward_backward(odds: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic tag for each word, and the expected number of each move between tags.

    odds: log-odds of the toxic tag from each word's features; bounds: first word of each chain, and the end.
    """
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    start, size = bounds[:-1][order], size[order]
    e = np.exp(np.clip(odds, -20, 20))
    m = np.exp(moves)
    alpha, beta = np.empty((2, len(odds))), np.ones((2, len(odds)))
    longest = int(size[0]) if len(size) else 0
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]  # chains with more than t words
    for t in range(longest):
        at = start[: active[t]] + t
        if t == 0:
            a0, a1 = np.full(len(at), 0.5), 0.5 * e[at]
        else:
            p0, p1 = alpha[0, at - 1], alpha[1, at - 1]
            a0, a1 = p0 * m[0, 0] + p1 * m[1, 0], (p0 * m[0, 1] + p1 * m[1, 1]) * e[at]
        total = a0 + a1
        alpha[0, at], alpha[1, at] = a0 / total, a1 / total
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        n0, n1 = beta[0, at + 1], beta[1, at + 1] * e[at + 1]
        b0, b1 = m[0, 0] * n0 + m[0, 1] * n1, m[1, 0] * n0 + m[1, 1] * n1
        total = b0 + b1
        beta[0, at], beta[1, at] = b0 / total, b1 / total
    joint = alpha * beta
    marginal = joint[1] / (joint[0] + joint[1])
    inner = np.ones(len(odds), bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)
    pair = alpha[:, None, at - 1] * m[:, :, None] * (beta[:, at] * np.stack([np.ones(len(at)), e[at]]))[None]
    expected = (pair / pair.sum((0, 1))).sum(2) if len(at) else np.zeros((2, 2))
    return marginal, expected


def _tokens(texts: list[str], config: ToxicityConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words of some texts, the text of each word, and the chains."""
    parts, rows, bounds, base = [], [], [np.zeros(0, np.int64)], 0
    for chunk in chunks(pa.array(texts, pa.large_string())):
        data = fold_case(chunk.data)
        words = find_words(chunk, data, ALNUM)
        parts.append(features(data, words, config.bits).astype(np.int32))
        rows.append(words.row + chunk.first)
        bounds.append(_chains(chunk, words, config.max_chain)[:-1] + base)
        base += len(words.start)
    if not parts:
        return np.zeros((0, 1 + len(PREFIXES)), np.int32), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate(rows), np.append(np.concatenate(bounds), base)


def label_words(feats: np.ndarray, rows: np.ndarray, toxic: np.ndarray, config: ToxicityConfig) -> np.ndarray:
    """True for words of toxic texts that have a feature which occurs in toxic texts beyond chance."""
    n, n_toxic = len(toxic), int(toxic.sum())
    if not n_toxic:
        return np.zeros(len(feats), bool)
    seen = np.repeat(rows.astype(np.int64), feats.shape[1])  # in place from here on: the driver's memory is bounded
    seen <<= config.bits
    seen |= feats.ravel()
    seen.sort()
    seen = seen[np.append(True, seen[1:] != seen[:-1])] if len(seen) else seen
    bucket, is_toxic = seen & (1 << config.bits) - 1, toxic[seen >> config.bits]
    hit = np.bincount(bucket[is_toxic], minlength=1 << config.bits)
    miss = np.bincount(bucket[~is_toxic], minlength=1 << config.bits)
    clean = max(1, n - n_toxic)
    rare = hit * math.log(n / n_toxic) if n_toxic < n else hit * math.log(2)
    lifted = hit / n_toxic >= config.lift * miss / clean
    telling = (rare >= -math.log(config.chance)) & lifted
    return telling[feats].any(1) & toxic[rows]


def document_odds(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log-odds that some word of each row is toxic, words taken as independent; ``first``: as in Words."""
    miss = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(marginal, 1 - 1e-9)))])
    none = miss[first[1:]] - miss[first[:-1]]
    some = -np.expm1(np.minimum(none, -1e-12))
    return np.log(some) - none


def fit(texts: list[str], toxic: list[int], config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """Train on labelled texts; without toxic ones the model scores every text low.

    The document score is calibrated on a fifth of the texts, chosen by the seed, with a field trained on the others; the
    field that is returned is trained on all. Where the fifth lacks a label, all texts calibrate.
    """
    y = np.array(toxic, dtype=bool)
    held = np.random.default_rng(config.seed).permutation(len(texts))[: len(texts) // 5]
    model = _train(texts, y, config)
    trial = model
    if not y.any():
        return model
    if 0 < y[held].sum() < len(held):
        rest = np.setdiff1d(np.arange(len(texts)), held)
        trial = _train([texts[k] for k in rest], y[rest], config)
    else:
        held = np.arange(len(texts))
    feats, rows, bounds = _tokens([texts[k] for k in held], config)
    marginal, _ = forward_backward(trial.weights[feats].sum(1, dtype=np.float64) + trial.bias, bounds, trial.moves)
    x = document_odds(marginal, np.searchsorted(rows, np.arange(len(held) + 1)))
    model.curve = _logistic(np.clip(x, -20, 20), y[held].astype(float))
    return model


def _train(texts: list[str], y: np.ndarray, config: ToxicityConfig) -> ToxicityModel:
    """The field alone, from made word labels."""
    model = ToxicityModel(np.zeros(1 << config.bits, np.float32), max_chain=config.max_chain)
    feats, rows, bounds = _tokens(texts, config)
    if not len(feats) or not y.any():
        return model
    tag = label_words(feats, rows, y, config).astype(float)
    rng = np.random.default_rng(config.seed)
    chain = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    busy = np.flatnonzero(np.bincount(chain, weights=tag, minlength=len(bounds) - 1) > 0)
    size = np.diff(bounds)
    weights, squares = np.zeros(1 << config.bits), np.full(1 << config.bits, 1e-2)
    bias, moves = model.bias, model.moves.copy()
    for _ in range(config.epochs):
        calm = rng.choice(len(bounds) - 1, min(len(bounds) - 1, max(256, 3 * len(busy))), replace=False)
        pick_ = rng.permutation(np.union1d(busy, calm))
        for at in range(0, len(pick_), config.batch):
            own = pick_[at : at + config.batch]
            n = size[own]
            ends = np.concatenate([[0], np.cumsum(n)])
            place = np.arange(ends[-1]) - np.repeat(ends[:-1], n) + np.repeat(bounds[:-1][own], n)
            f, t = feats[place], tag[place]
            marginal, expected = forward_backward(weights[f].sum(1) + bias, ends, moves)
            slip = t - marginal
            step = np.bincount(f.ravel(), np.repeat(slip, f.shape[1]), 1 << config.bits) - config.decay * weights
            squares += step**2
            weights += config.rate * step / np.sqrt(squares)
            bias += config.rate * slip.sum() / max(1.0, len(t)) ** 0.5 * 0.1
            inner = np.ones(len(t), bool)
            inner[ends[:-1]] = False
            i = np.flatnonzero(inner)
            seen = np.bincount((2 * t[i - 1] + t[i]).astype(int), minlength=4).reshape(2, 2)
            moves += config.rate * (seen - expected) / max(1, len(i))
    model.weights, model.bias, model.moves = weights.astype(np.float32), float(bias), moves
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps with a little shrinkage."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, g = p * (1 - p), p - y
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        da, db = np.linalg.solve(h, [(g * x).sum() + 0.1 * (a - 1), g.sum() + 0.1 * b])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return float(max(a, 0.05)), float(b)


def sample_labelled(docs: DataFrame, labels: DataFrame, usable: Column, config: ToxicityConfig = ToxicityConfig()) -> tuple[list[str], list[int]]:
    """Texts and toxic labels to learn from: of each label a share of its usable rows, by a hash of doc_id.

    The sample's ids are bounded by the config, which is what allows them to be sent to every task. Repeated rows of an id
    count once, with its least text, so that copies neither fill the sample nor reach the driver; null ids teach nothing.
    """
    rows = labels.filter(usable & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 30))
    share = {1: config.toxic_rows / counts.get(1, 1), 0: config.clean_rows / counts.get(0, 1)}
    cut = F.when(F.col("toxic") == 1, int((1 << 30) * min(1.0, share[1]))).otherwise(int((1 << 30) * min(1.0, share[0])))
    ids = rows.filter(place < cut).orderBy(place, "doc_id", "toxic").limit(2 * (config.toxic_rows + config.clean_rows))
    short = docs.filter(F.length("text") <= config.max_chars).select("doc_id", "text")
    got = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    got.sort(key=lambda r: (str(r["doc_id"]), r["text"], r["toxic"]))
    return [r["text"] for r in got], [r["toxic"] for r in got]


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, span_from: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score double, predicted int, spans`` (input columns of these names are replaced).

    ``score`` is the calibrated chance that the document is toxic (a null or empty text has the chance of a text
    without toxic words), ``predicted`` is 1 from ``threshold`` on, ``spans`` has the words whose marginal is
    ``span_from`` or more: first and end code point and marginal. Whole texts are read; equal texts score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", T.ArrayType(span))]

    def compute(batch: pa.RecordBatch) -> list:
        m: ToxicityModel = shared.value
        bits = len(m.weights).bit_length() - 1
        scores, spans = [], []
        for chunk in chunks(pick(batch, text_col)):
            data = fold_case(chunk.data)
            words = find_words(chunk, data, ALNUM)
            odds = m.weights[features(data, words, bits)].sum(1, dtype=np.float64) + m.bias
            marginal, _ = forward_backward(odds, _chains(chunk, words, m.max_chain), m.moves)
            z = m.curve[0] * np.clip(document_odds(marginal, words.first), -20, 20) + m.curve[1]
            scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            own: list[list[dict]] = [[] for _ in range(chunk.rows)]
            hits = np.flatnonzero(marginal >= span_from)
            if len(hits):
                points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
                for k in hits:
                    row = int(words.row[k])
                    base = points[chunk.bounds[row]]
                    own[row].append({"start": int(points[words.start[k]] - base), "end": int(points[words.end[k]] - base), "p": float(marginal[k])})
            spans += own
        flat = np.concatenate(scores) if scores else np.zeros(0)
        return [flat, (flat >= threshold).astype(np.int32), spans]

    return append(docs, fields, compute)
