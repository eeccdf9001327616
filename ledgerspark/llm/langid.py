"""Language ID: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are the byte n-grams of the text (ASCII lower-cased, digits and white space folded), hashed into
buckets. A text is the mean of its n-grams' embeddings; a linear softmax over it is trained together with
the embeddings by stochastic gradient descent. As both steps are linear, the trained model folds into one
score per bucket and language, so that scoring a text is a sum of table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick
from ledgerspark.llm.bytescan import LOWER, Chunk, chunks

ORDERS = (2, 3, 4)
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = LOWER.copy()
_FOLD[[*range(0x09, 0x0E)]] = 0x20
_FOLD[0x30:0x3A] = 0x30


@dataclass(frozen=True)
class LangidConfig:
    """Bounds of the fit: about ``rows_per_language`` texts for each language, of each a stretch of at most ``max_chars``, and
    ``total_chars`` in all, shared among all languages: with many of them stretches become shorter, then rows fewer."""

    rows_per_language: int = 500
    max_chars: int = 20_000
    least_chars: int = 500
    total_chars: int = 40_000_000
    bits: int = 16
    dim: int = 16
    epochs: int = 6
    rate: float = 2.0
    seed: int = 7
    lost_share: float = 0.001
    reject_at_most: float = 0.6


@dataclass
class LangidModel:
    """scores: one row per bucket, one column per language; a confidence under ``reject_below`` is a rejection."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def _grams(chunk: Chunk, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram at each byte, and whether it lies within one row."""
    b = _FOLD[chunk.data].astype(np.uint32)
    for n in ORDERS:
        if len(b) < n:
            continue
        code = np.full(len(b) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            code += b[k : len(b) - n + 1 + k] << np.uint32(8 * k)
            code *= np.uint32(0x85EBCA6B)
            code ^= code >> np.uint32(15)
        inside = np.ones(len(code), bool)
        for k in range(1, n):
            at = chunk.bounds[1:-1] - k
            inside[at[(at >= 0) & (at < len(code))]] = False
        yield (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits), inside


def row_scores(chunk: Chunk, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the table's rows over the n-grams of each text, and how many those are."""
    total, count = np.zeros((chunk.rows, table.shape[1])), np.zeros(chunk.rows)
    filled = np.flatnonzero(chunk.bounds[1:] > chunk.bounds[:-1])
    for bucket, inside in _grams(chunk, bits):
        rows = filled[chunk.bounds[filled] < len(bucket)]
        at = chunk.bounds[rows]
        values = table[bucket]
        values[~inside] = 0
        total[rows] += np.add.reduceat(values, at, axis=0)
        count[rows] += np.add.reduceat(inside, at, dtype=np.int64)
    return total, count


def fit(texts: list[str], langs: list[str], config: LangidConfig = LangidConfig()) -> LangidModel:
    """Train on labelled texts; a fifth of them, chosen by the seed, calibrates. No texts: a model that knows none."""
    languages = sorted(set(langs))
    if not languages:
        return LangidModel([], np.zeros((1 << config.bits, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(config.seed)
    y = np.array([languages.index(x) for x in langs])
    order = rng.permutation(len(texts))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    for chunk in chunks(pa.array(texts, pa.large_string()), 1):
        ids = [bucket[inside] for bucket, inside in _grams(chunk, config.bits)]
        bag, n = np.unique(np.concatenate(ids) if ids else np.zeros(0, np.uint32), return_counts=True)
        bags.append((bag, (n / max(1, n.sum())).astype(np.float32)))
    embed = rng.normal(0, 0.1, (1 << config.bits, config.dim)).astype(np.float32)
    linear = rng.normal(0, 0.1, (config.dim, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, at = config.epochs * max(1, len(train)), 0
    for _ in range(config.epochs):
        for i in rng.permutation(train):
            rate = config.rate * (1 - at / steps)
            at += 1
            bag, w = bags[i]
            hidden = w @ embed[bag]
            z = hidden @ linear + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = linear @ p
            linear -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            embed[bag] -= (rate * w)[:, None] * back * min(10.0, len(bag) ** 0.5)
    scores = embed @ linear
    z = np.array([w @ scores[bag] + bias for bag, w in (bags[i] for i in held)]).reshape(len(held), len(languages))
    temperature, reject = 1.0, 0.0
    if len(held):
        losses = {t: _loss(z / t, y[held]) for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)}
        temperature = min(losses, key=losses.get)
        p = _softmax(z / temperature)
        right = p.max(1)[p.argmax(1) == y[held]]
        if len(right) and len(languages) > 1:
            reject = min(config.reject_at_most, float(np.quantile(right, config.lost_share)) * 0.9)
    return LangidModel(languages, scores.astype(np.float32), bias.astype(np.float64), temperature, reject)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def sample_labelled(docs: DataFrame, usable: Column, config: LangidConfig = LangidConfig(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: of each language a share of its usable rows, by a hash of id and text.

    Every value of ``lang_col`` is learned. Of a text over the bound a stretch is taken, at a place by the same hash.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    rows = docs.filter(usable & lang.isNotNull() & text.isNotNull()).select(text.alias("text"), lang.alias("lang"), F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("h"))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return [], []
    chars = max(config.least_chars, min(config.max_chars, config.total_chars // (config.rows_per_language * len(counts))))
    wanted = max(1, min(config.rows_per_language, config.total_chars // (chars * len(counts))))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], int((1 << 30) * min(1.0, wanted / r[1])) + 1)])
    place = F.pmod("h", F.lit(1 << 30))
    spare = F.greatest(F.length("text") - chars, F.lit(0))
    stretch = F.substring("text", F.pmod(F.shiftright("h", 30), spare + 1).cast("int") + 1, F.lit(chars))
    got = rows.filter(place < share[F.col("lang")]).orderBy(place, "h").limit(2 * wanted * len(counts) + 64).select(stretch, "lang").collect()
    return [r[0] for r in got], [r[1] for r in got]


def predict(docs: DataFrame, model: LangidModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred string, score double, accepted boolean``.

    ``lang_pred`` is a learned language, or ``und`` with score 0, not accepted, where the text is null or
    has no letter or no language was learned. ``score`` is the calibrated probability of ``lang_pred``;
    ``accepted`` is false under the model's rejection level. Equal texts get equal results; input columns
    of these three names are replaced. Whole texts are read, in chunks of bounded bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bits = int(model.scores.shape[0]).bit_length() - 1

    def compute(batch: pa.RecordBatch) -> list:
        m: LangidModel = shared.value
        column = pick(batch, text_col)
        names, scores, accepted = [], [], []
        for chunk in chunks(column):
            z, n = row_scores(chunk, m.scores, bits)
            p = _softmax((z / np.maximum(n, 1)[:, None] + m.bias) / m.temperature) if m.languages else z
            for k in range(chunk.rows):
                text = column[chunk.first + k].as_py()
                known = bool(m.languages) and text is not None and _LETTER.search(text) is not None
                best = int(p[k].argmax()) if known else -1
                names.append(m.languages[best] if known else UNDETERMINED)
                scores.append(min(1.0, float(p[k, best])) if known else 0.0)
                accepted.append(known and scores[-1] >= m.reject_below)
        return [names, scores, accepted]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    return append(docs, fields, compute)
