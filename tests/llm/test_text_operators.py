"""Chat, fingerprints, shingle join, mixing and packing against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import chat, components, fingerprints, mixing, packing, queries, shinglejoin
from tests.conftest import SF

DOCS = "doc_id long, text string, source string, size string, node string"


def frame(spark, rows, extra=("s", "x", "y")):
    """Documents with further columns whose names operators use inside."""
    return spark.createDataFrame([(*r, *extra[len(r) - 2 :]) for r in rows], DOCS)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


# --- chat ----------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    r = random.Random(1)
    bits = ["<", "\\", "|", "[", "</s>", "<|turn|>", "<|text|>", "<|more|>", "[INST]", "[/INST]", "<\\/s>", "<\\\\|text|>", "a", "é", "\n", "😀", ""]
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "</s>", None, "a\nb"]), None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randint(0, 8)))) for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(100, 0, "user", "tie b"), (100, 0, "user", "tie a"), (100, None, "user", "first"), (None, 0, "user", "no id")]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_chat(df).withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    got = {x["conv_id"]: x for x in done.collect()}
    wanted = collections.defaultdict(list)
    for c, t, role, text in rows:
        wanted[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == set(wanted)
    for c, turns in wanted.items():
        turns = sorted(turns)
        assert [tuple(x) for x in got[c]["turns"]] == [x[1:] for x in turns]
        assert got[c]["loss"] == "".join(x[2] for x in turns if x[1] == "assistant")
        runs = sum(k == 0 or turns[k - 1][1] != x[1] for k, x in enumerate(turns))
        assert got[c]["formatted"].count("<|turn|>") == runs


def test_chat_empty_and_long(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chat(empty).count() == 0
    long = spark.range(1300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    row = chat.format_chat(long).select(chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("x")).first()
    assert row["x"] == "".join(str(k) for k in range(1300) if k % 3)


@pytest.mark.parametrize("name", ["op1_chat", "op4_mixing"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    wanted = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(map(str, queries.QUERIES[name](spark, SF).select(columns).toPandas().itertuples(index=False, name=None))) == sorted(map(str, wanted.df().itertuples(index=False, name=None)))


# --- fingerprints --------------------------------------------------------------------------------------------


def bag(text):
    return collections.Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text) if w)


def jaccard(a, b):
    words = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words) if words else 1.0


def test_fingerprints_of_documents(spark, documents):
    got = {r["doc_id"]: r for r in queries.op2_fingerprints(spark, SF).collect()}
    rows = [(d, t) for d, t, *_ in reversed(documents)]
    errors, same = [], {}
    for k, (d, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert got[d]["n_chars"] == len(text)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [got[d]["near_edited"] - jaccard(bag(text), bag(edited)), got[d]["near_next"] - jaccard(bag(text), bag(other))]
        assert same.setdefault(text, got[d]["fingerprint"]) == got[d]["fingerprint"]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.08


def test_fingerprint_edges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 2)
    rows = [(5, "a b c d"), (4, None), (3, ""), (2, "a b c d"), (2, "a b c d"), (1, "x"), (10**12, "far away text"), (None, "no id")]
    got = {(r["doc_id"], r["n_chars"]): r for r in fingerprints.fingerprint_neighbours(frame(spark, rows)).collect()}
    assert len(got) == 7
    assert got[(4, 0)]["fingerprint"] == "" and got[(4, 0)]["near_next"] == 1.0 and got[(5, 7)]["near_next"] == 0.0
    assert got[(5, 7)]["fingerprint"] == got[(2, 7)]["fingerprint"]
    assert got[(10**12, 13)]["edited_sha256"] == hashlib.sha256(b"far awaa b c ").hexdigest()
    assert got[(None, 5)]["edited_sha256"] == hashlib.sha256(b"no fa").hexdigest()
    assert fingerprints.fingerprint_neighbours(frame(spark, [])).count() == 0


def test_fingerprint_ranges_are_even(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 50)
    rows = [(k, f"t{k}") for k in range(1000)] + [(10**15, "far"), (-(10**15), "low")] + [(7, f"same id {k}") for k in range(500)] + [(None, f"no id {k}") for k in range(500)]
    got = fingerprints.with_next(frame(spark, rows)).filter("NOT extra").collect()
    sizes = collections.Counter(r["range"] for r in got)
    assert len(got) == 2002 and len(sizes) >= 20 and max(sizes.values()) <= 200
    following = {(r["id"], r["text"]): (r["next_id"], r["next_text"]) for r in got}
    at, seen = (10**15, "far"), []
    for _ in rows:
        seen.append(at)
        at = following[at]
    assert at == seen[0] and len(set(seen)) == 2002
    assert [i for i, _ in seen] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0), reverse=True)


def test_fingerprints_of_string_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "u v"), ("é", "p q"), (None, "z")], "doc_id string, text string")
    got = {r["id"]: r["next_id"] for r in fingerprints.with_next(df).filter("NOT extra").collect()}
    assert got == {"é": "b", "b": "a", "a": None, None: "é"}
    assert fingerprints.fingerprint_neighbours(df).count() == 4


def test_heavier_words_count_more(spark):
    df = spark.createDataFrame([(1, "a " * 30 + "b", "a " * 20 + "c")], "i int, x string, y string")
    r = fingerprints.fingerprint(df, ["i"], ["x", "y"], 1024).select(fingerprints.likeness(F.col("fp0"), F.col("fp1"), 1024).alias("n")).first()
    assert r["n"] == pytest.approx(20 / 32, abs=0.06)


# --- shingle join --------------------------------------------------------------------------------------------


def plain_components(rows, width=5):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if j < i and shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies():
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [r.choice(vocabulary) for _ in range(90)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(r.randint(1, 3)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((k, " ".join(words)))
    rows += [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60))) + " " + " ".join(base[: r.randint(0, 60)])) for k in range(60, 90)]
    return rows + [(90, None), (91, ""), (92, " \n\t"), (93, "a b"), (94, "A  B"), (95, "a b c d e"), (96, " ".join(base).upper()), (97, " ".join(base))]


@pytest.mark.parametrize("config", [shinglejoin.JoinConfig(), shinglejoin.JoinConfig(small_tile=2, block_items=1500), shinglejoin.JoinConfig(bucket_bits=8, hot_from=20, hot_times=1, salts=3, small_tile=2, block_rows=7)])
def test_shingle_join(spark, config):
    rows = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shinglejoin.similar_texts(frame(spark, rows), config).collect()}
    assert got == plain_components(rows)


def test_shingle_join_edges(spark):
    rows = [(1, "same words here again now"), (1, "same words here again now"), (None, "same words here again now"), (None, "alone")]
    got = sorted(map(tuple, shinglejoin.similar_texts(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (None, 1, 1), (None, 1, None)], key=str)
    assert shinglejoin.similar_texts(frame(spark, [])).count() == 0


@pytest.mark.parametrize("config", [shinglejoin.JoinConfig(small_tile=2, block_items=1500)])
def test_shingle_join_counts_every_link(spark, config):
    rows = near_copies() + [(98, "a b"), (None, "a b")]
    sets = [frozenset(zip(*[(t or "").lower().split()[k:] for k in range(5)], strict=False)) or frozenset([tuple((t or "").lower().split())] if (t or "").split() else []) for _, t in rows]
    linked = lambda a, b: len(a & b) > 0 and 100 * len(a & b) >= 80 * len(a | b)
    wanted = {i: sum(linked(a, b) for j, b in enumerate(sets) if j != k) for k, ((i, _), a) in enumerate(zip(rows, sets, strict=True))}
    assert {r["doc_id"]: r["n_links"] for r in shinglejoin.count_links(frame(spark, rows), config).collect()} == wanted
    assert sum(wanted.values()) > 2 * len(rows)


def test_null_and_repeated_ids_are_linked_and_kept_once(spark):
    words = [f"w{k}" for k in range(60)]
    chain = [" ".join(words[k : k + 54]) for k in (0, 3, 6)]  # neighbours are linked, the ends are not
    plain = plain_components(list(enumerate(chain)))
    assert plain_components([(0, chain[0]), (2, chain[2])])[2][1] == 2 and plain[2][1] == 0
    other = " ".join(f"v{k}" for k in range(40))
    rows = [(3, chain[0]), (None, chain[1]), (5, chain[2]), (None, other), (None, other), (None, other + " end"), (7, "x y z"), (7, "x y z"), (9, None), (None, ""), (None, "")]
    rows += [(11, "one text that heads its own component here"), (11, chain[0] + " end"), (12, "p q r s t u v w x y"), (12, "p q r s t u v w x y")]
    got = shinglejoin.similar_texts(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got if r["n_shingles"] >= 50) == [(0, 3), (3, 3), (5, 3), (11, 3)]
    kept = shinglejoin.keep_one(frame(spark, rows)).collect()
    assert len(kept[0]) == 5
    alone = [r for r in kept if r["text"] is not None and r["text"].startswith("v0")]
    assert len(alone) == 1
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r not in alone) == sorted([("3", chain[0]), ("7", "x y z"), ("9", None), ("None", ""), ("None", ""), ("11", rows[11][1]), ("12", rows[13][1])], key=lambda x: (x[0], x[1] or ""))
    assert shinglejoin.keep_one(frame(spark, [])).count() == 0


def test_bitmap_bounds_overlap():
    r = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(r.integers(0, 500, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in r.integers(1, 400, 2))
        assert shinglejoin.overlap(a, b) == len(np.intersect1d(a, b))
        assert shinglejoin.overlap_bound(shinglejoin.bitmap(a), shinglejoin.bitmap(b), len(a) + len(b)) >= shinglejoin.overlap(a, b)


def test_components(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 400), (400, 450), (7, 7), (None, 3), (500, 400)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, 400: 400, 450: 400, 500: 400}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- mixing --------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        target = {s: most * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in rest) for s in names}
        over = {s for s in rest if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(spark):
    r = random.Random(2)
    rows = [(k, " ".join(["w"] * r.randint(0, 30)) if k % 17 else None, r.choice(["a", "b", "c", "é", None, "tiny"] if k % 40 == 0 else ["a", "b", "b", "c", "é", None])) for k in range(3000)]
    got = mixing.mix_sources(frame(spark, rows)).collect()
    again = mixing.mix_sources(frame(spark, list(reversed(rows)))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for x in got:
        sizes[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
        assert 0 <= x["taken"] <= 3 * x["size"]
    for s, wanted in plain_targets(sizes).items():
        assert target[s] == pytest.approx(wanted)
        assert abs(taken[s] - wanted) <= 15
    kept = mixing.take_mix(frame(spark, rows)).groupBy("doc_id").count().collect()
    assert {x["doc_id"]: x["count"] for x in kept} == {x["doc_id"]: x["copies"] for x in got if x["copies"]}


def test_mixing_edges(spark):
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    got = mixing.mix_sources(frame(spark, [(1, None, "a"), (None, "", "b"), (2, " ", None)])).collect()
    assert [(x["size"], x["target"], x["taken"]) for x in got] == [(0, 0.0, 0)] * 3


# --- packing -------------------------------------------------------------------------------------------------


def test_packing(spark):
    r = random.Random(4)
    rows = [(k, " ".join(["w"] * r.choice([0, 1, 5, 30, 70, 100, 250]))) for k in range(400)] + [(7, "w w w"), (1000, None)]
    config = packing.PackConfig(lengths=(32, 64, 100), rows_per_shard=150)
    got = packing.pack(frame(spark, rows), config).collect()
    bins, pieces = collections.defaultdict(list), collections.Counter()
    for x in got:
        pieces[x["doc_id"]] += x["length"]
        if x["length"]:
            bins[x["bin"]].append(x)
        else:
            assert x["bin"] is None
    wanted = collections.Counter()
    for d, text in rows:
        wanted[d] += len((text or "").split())
    assert pieces == wanted
    for own in bins.values():
        spans = sorted((x["offset"], x["offset"] + x["length"]) for x in own)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
        held = spans[-1][1]
        assert {x["capacity"] for x in own} == {min(c for c in config.lengths if c >= held)}
    assert packing.pack(frame(spark, [])).count() == 0


def test_best_fit_takes_the_tightest_bin():
    config = packing.PackConfig(lengths=(10,))
    bins, offsets, held = packing.best_fit([7, 6, 4, 3], config, [10])
    assert bins == [0, 1, 1, 0] and held == [10, 10] and offsets == [0, 0, 6, 7]
    cheap = packing.PackConfig(lengths=(10, 20), fixed=0, quadratic=1.0)
    assert packing.pack_sizes([10, 10], cheap)[2] == [10, 10]
    dear = packing.PackConfig(lengths=(10, 20), fixed=1000, quadratic=1e9)
    assert packing.pack_sizes([10, 10], dear)[2] == [20]


def least_cost(sizes, config):
    """Over all ways of dealing pieces out to bins."""
    best = [float("inf")]

    def deal(k, bins):
        if k == len(sizes):
            best[0] = min(best[0], sum(config.cost(packing.downsize(b, config)) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= max(config.lengths):
                deal(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1 :]])
        deal(k + 1, [*bins, sizes[k]])

    deal(0, [])
    return best[0]


@pytest.mark.parametrize("config", [packing.PackConfig(), packing.PackConfig(lengths=(512, 1024, 4096), fixed=400), packing.PackConfig(lengths=(300, 700, 4096), quadratic=2000.0)])
def test_packing_is_near_the_least_cost(config):
    r, ratios = random.Random(9), []
    for _ in range(60):
        sizes = sorted((r.choice([r.randint(1, 600), r.randint(1, 2000), r.randint(1, 4096)]) for _ in range(r.randint(1, 8))), reverse=True)
        bins, offsets, final = packing.pack_sizes(sizes, config)
        held = collections.Counter()
        for b, o, n in zip(bins, offsets, sizes, strict=True):
            assert o == held[b]
            held[b] += n
        assert all(final[b] == packing.downsize(h, config) for b, h in held.items()) and len(held) == len(final)
        ratios.append(sum(map(config.cost, final)) / least_cost(sizes, config))
    assert np.mean(ratios) < 1.02 and max(ratios) < 1.2


def test_packing_spreads_null_ids(spark):
    rows = [(None, "w w w")] * 700 + [(None, None)] * 300 + [(None, "w " * 5000)] * 2
    got = packing.pack(frame(spark, rows), packing.PackConfig(rows_per_shard=100)).collect()
    shards = collections.Counter(x["bin"] >> 32 for x in got if x["length"])
    assert sum(x["length"] for x in got) == 2100 + 10_000 and len(got) == 1004 and len(shards) >= 9 and max(shards.values()) < 130


def test_queries_of_whole_tables(spark, documents):
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t, *_ in documents}
    held, capacity, found = collections.Counter(), {}, collections.Counter()
    for x in queries.op6_packing(spark, SF).collect():
        found[x["doc_id"]] += x["length"]
        if x["length"]:
            held[x["bin"]] += x["length"]
            capacity[x["bin"]] = x["capacity"]
    assert found == sizes and all(packing.downsize(h, packing.PackConfig()) == capacity[b] for b, h in held.items())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op3_jaccard(spark, SF).collect()}
    assert got == plain_components([(d, t) for d, t, *_ in documents])


def test_columns_with_dots_and_whole_copies(spark):
    texts = [(k, "", "a") for k in range(60)] + [(100, "w w", "a"), (101, "w " * 500, "b")]
    df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, source string, `a.b` int")
    taken = mixing.take_mix(df)
    assert taken.columns == df.columns
    assert {r["count"] for r in taken.filter("source = 'a'").groupBy("doc_id").count().collect()} == {3}
    assert shinglejoin.keep_one(df).select("`a.b`").count() == 62 and packing.pack(df).count() == 62
