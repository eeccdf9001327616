"""Vectorised scanning of Arrow string columns as UTF-8 bytes.

Word classes here are made of ASCII bounds only, so a byte test equals the code point test: bytes of
0x80 and above are parts of non-ASCII code points, which every class used below counts as word characters.
Batches are cut into chunks of bounded bytes (a longer text is a chunk of its own), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def fold_case(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the two-byte capitals U+00C0 to U+00DE lower-cased."""
    out = LOWER[data]
    if len(data) > 1:
        tail = data[1:]
        capital = (data[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        out[1:][capital] += 0x20
    return out


#: ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text whose A-Z are lower-cased
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds), in place on a uint64 array."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the rolling multiplier, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 1024, 2 * len(_powers)), _MULTIPLIER, np.uint64)
        factors[0] = 1
        _powers = np.multiply.accumulate(factors)
    return _powers[:n]


@dataclass
class Chunk:
    """Consecutive rows of a batch: their bytes and, per row, where those begin and end."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of a chunk in text order: byte ranges, row of each, and the first word of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of a string column, null as empty, in chunks of about ``max_bytes``."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield Chunk(at, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at])
        at = stop


def find_words(chunk: Chunk, data: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``inside`` holds; a run never crosses rows."""
    flag = inside[data]
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[:n] = flag
    begins[1:n] &= ~flag[:-1]
    ends = np.zeros(n + 1, bool)
    ends[1:] = flag
    ends[1:n] &= ~flag[1:]
    inner = chunk.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    cut = inner[flag[inner] & flag[inner - 1]]
    begins[cut] = True
    ends[cut] = True
    start = np.flatnonzero(begins)
    row = np.searchsorted(chunk.bounds, start, "right") - 1
    return Words(start, np.flatnonzero(ends), row, np.searchsorted(start, chunk.bounds, "left"))


def word_prefix_sums(data: np.ndarray, words: Words) -> np.ndarray:
    """c with c[e] - c[s] the rolling hash of bytes s to e, if s is a word's start and e lies within that word."""
    lengths = words.end - words.start
    total = int(lengths.sum())
    c = np.zeros(len(data) + 1, np.uint64)
    if total:
        place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = place + np.repeat(words.start, lengths)
        terms = np.zeros(len(data), np.uint64)
        terms[at] = _TABLE[data[at]] * powers(int(lengths.max()))[place]
        np.cumsum(terms, out=c[1:])
    return c


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, alike in every chunk, batch and process."""
    c = word_prefix_sums(data, words)
    return mix((c[words.end] - c[words.start]) + (words.end - words.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_word(word: str) -> np.uint64:
    """word_hashes() of a single word."""
    data = np.frombuffer(word.encode(), np.uint8)
    n = len(data)
    return word_hashes(data, Words(np.array([0]), np.array([n]), np.array([0]), np.array([0, 1])))[0]
