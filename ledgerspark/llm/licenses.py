"""License scans: an exact set-similarity join of text blocks with licence templates.

A block is a run of words of a text, of any place and not longer than a template's words over the threshold; line ends and
lines without words mean nothing. Block and template are word sets; a block matches when it holds at least ``threshold``
of a template's words (all of them, for templates of under ``SHORT`` words, where one missing word is another sentence).
Tokens are ordered by their frequency over all documents, rarest first. A block that can match holds one of a template's
first ``n - need + 1`` tokens in that order (prefix filter), has ``need`` tokens at least (length filter), and from the
first shared token on enough are left on both sides (positional filter); what remains is counted exactly.
The templates, not the documents, are the indexed side: they are few, fixed, and sent to every task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick, rows
from ledgerspark.llm.bytescan import ALNUM, LOWER, Chunk, Words, chunks, find_words, hash_word, word_hashes

#: Phrases whose every place counts, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Sentences and whole texts of public licences, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
)

#: Templates of fewer distinct words must be held wholly.
SHORT = 8

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split_words(text: str) -> list[str]:
    """A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass
class TemplateIndex:
    """tokens: hashes of all template words, sorted; rank: place of each in the global order, rarest first."""

    labels: list[str]
    tokens: np.ndarray
    rank: np.ndarray
    sets: list[list[int]]
    need: list[int]
    most: list[int]
    prefix: dict[int, list[tuple[int, int]]]


def _vocabulary(templates: Sequence[tuple[str, str]]) -> np.ndarray:
    return np.array(sorted({int(hash_word(w)) for _, text in templates for w in split_words(text)}), np.uint64)


def _known(hashes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes that are tokens, and which token each is."""
    at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
    place = np.flatnonzero(tokens[at] == hashes)
    return place, at[place]


def count_tokens(docs: DataFrame, tokens: np.ndarray, text_col: str = "text") -> np.ndarray:
    """Occurrences of each token over all documents; the result has one number per token."""
    schema = T.StructType([T.StructField("token", T.IntegerType()), T.StructField("n", T.LongType())])

    def produce(batch: pa.RecordBatch):
        total = np.zeros(len(tokens), np.int64)
        for chunk in chunks(pick(batch, text_col)):
            data = LOWER[chunk.data]
            words = find_words(chunk, data, ALNUM)
            total += np.bincount(_known(word_hashes(data, words), tokens)[1], minlength=len(tokens))
        at = np.flatnonzero(total)
        yield {"token": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())}

    counts = np.zeros(len(tokens), np.int64)
    for r in rows(docs.select(text_col), schema, produce).groupBy("token").agg(F.sum("n").alias("n")).collect():
        counts[r["token"]] = r["n"]
    return counts


def build_index(templates: Sequence[tuple[str, str]], tokens: np.ndarray, counts: np.ndarray, threshold: float) -> TemplateIndex:
    order = np.lexsort((tokens, counts))
    rank = np.empty(len(tokens), np.int64)
    rank[order] = np.arange(len(tokens))
    at = {int(t): k for k, t in enumerate(tokens)}
    sets = [sorted({int(rank[at[int(hash_word(w))]]) for w in split_words(text)}) for _, text in templates]
    need = [len(s) if len(s) < SHORT else max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
    most = [max(1, int(len(split_words(text)) / threshold + 1e-9)) for _, text in templates]
    prefix: dict[int, list[tuple[int, int]]] = {}
    for k, (s, n) in enumerate(zip(sets, need, strict=True)):
        for i, r in enumerate(s[: len(s) - n + 1]):
            prefix.setdefault(r, []).append((k, i))
    return TemplateIndex([label for label, _ in templates], tokens, rank, sets, need, most, prefix)


def match_blocks(chunk: Chunk, words: Words, hashes: np.ndarray, index: TemplateIndex) -> list[tuple[int, int, int, int, float]]:
    """(row, template, first word, end word, containment) of blocks that meet a template's threshold: of blocks that overlap
    the fullest, of equals the first, is told; every block that meets the threshold overlaps one that is told."""
    place, token = _known(hashes, index.tokens)
    ranks, row = index.rank[token], words.row[place]
    found: list[tuple[int, int, int, int, float]] = []
    hits: dict[int, list[int]] = {}
    for at in np.flatnonzero(np.isin(ranks, list(index.prefix))):
        for k, i in index.prefix[int(ranks[at])]:
            lo, hi = np.searchsorted(place, [place[at] - index.most[k] + 1, place[at] + index.most[k]])
            if hi - lo < index.need[k]:
                continue
            near = np.unique(ranks[lo:hi][row[lo:hi] == row[at]])
            if min(len(index.sets[k]) - i, len(near)) >= index.need[k]:
                hits.setdefault(k, []).append(int(at))
    for k, anchors in hits.items():
        own = np.isin(ranks, index.sets[k])
        at = np.flatnonzero(own)
        seats, kind, line = place[at], ranks[at], row[at]
        wanted = np.unique(np.searchsorted(at, anchors))
        first = np.searchsorted(seats, seats[wanted] - index.most[k] + 1)
        starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, wanted, strict=True)]))
        ends = np.searchsorted(seats, seats[starts] + index.most[k])
        windows = []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s < index.need[k]:
                continue
            while line[e - 1] != line[s]:
                e -= 1
            shared = len(set(kind[s:e].tolist()))
            if shared >= index.need[k]:
                windows.append((-shared, int(seats[s]), int(seats[e - 1]) + 1, int(line[s])))
        taken: list[tuple[int, int]] = []
        for shared, lo, hi, r in sorted(windows):
            if all(hi <= a or lo >= b for a, b in taken):
                taken.append((lo, hi))
                base = int(words.first[r])
                found.append((r, k, lo - base, hi - base, -shared / len(index.sets[k])))
    return sorted(found)


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """``docs`` with its licence columns (input columns of these names are replaced):

    ``n_words, n_base, first_word, last_word long`` (places of the phrases: how many, smallest and largest
    start, words from 0, null if none), ``base_labels, labels string`` (distinct, sorted, comma-joined; of
    the phrases, and with the templates'), ``score double`` (1 where a phrase stands, else the best containment
    that meets the threshold, else 0) and ``matches`` (template, first and end word of the block, containment).
    A template that occurs several times gives a match each. A null or empty text has no words and empty labels. Whole texts are read; repeated rows get equal values.
    """
    tokens = _vocabulary(templates)
    index = build_index(templates, tokens, count_tokens(docs, tokens, text_col), threshold)
    labels = list(dict.fromkeys(phrases.values()))
    wanted = [([hash_word(w) for w in split_words(p)], labels.index(label)) for p, label in phrases.items()]
    match_type = T.StructType([T.StructField("template", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType())])
    fields = [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
    fields += [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("matches", T.ArrayType(match_type))]

    def compute(batch: pa.RecordBatch) -> list:
        out: list[list] = [[] for _ in fields]
        for chunk in chunks(pick(batch, text_col)):
            data = LOWER[chunk.data]
            words = find_words(chunk, data, ALNUM)
            hashes = word_hashes(data, words)
            n_base, first, last = np.zeros(chunk.rows, np.int64), [None] * chunk.rows, [None] * chunk.rows
            base: list[set[str]] = [set() for _ in range(chunk.rows)]
            for parts, label in wanted:
                m = len(hashes) - len(parts) + 1
                if m <= 0:
                    continue
                here = words.row[:m] == words.row[len(parts) - 1 :]
                for k, h in enumerate(parts):
                    here &= hashes[k : k + m] == h
                for at in np.flatnonzero(here):
                    row = int(words.row[at])
                    start = int(at - words.first[row])
                    n_base[row] += 1
                    first[row] = start if first[row] is None else min(first[row], start)
                    last[row] = start if last[row] is None else max(last[row], start)
                    base[row].add(labels[label])
            matches: list[list[dict]] = [[] for _ in range(chunk.rows)]
            for row, k, lo, hi, c in match_blocks(chunk, words, hashes, index):
                matches[row].append({"template": k, "first": lo, "end": hi, "containment": c})
            n_words = np.diff(words.first)
            for r in range(chunk.rows):
                every = base[r] | {index.labels[x["template"]] for x in matches[r]}
                score = 1.0 if base[r] else max((x["containment"] for x in matches[r]), default=0.0)
                for column, value in zip(out, (int(n_words[r]), int(n_base[r]), first[r], last[r], ",".join(sorted(base[r])), ",".join(sorted(every)), score, matches[r]), strict=True):
                    column.append(value)
        return out

    return append(docs, fields, compute)
