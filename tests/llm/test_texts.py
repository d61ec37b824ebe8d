"""Decontamination and near duplicates against brute force."""

import hashlib
import random
import re
from math import comb

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from tabulaire.llm import decontaminate, near
from tabulaire.llm.common import sieve
from tabulaire.llm.words import word_hashes
from tests.llm.conftest import ODD, SCHEMA, rows_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
words = lambda t: WORD.findall((t or "").encode().lower())
BENCH = [(1, "quick brown fox jumps over the lazy dog again and again"), (2, "nobody KNOWS"), (3, None), (4, ""), (10, "123"), (2, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"), (None, "the"), (5, "!!"), (6, "Ünïcödé ſtraße")]


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for key, item in items:
        w = words(item)
        if key is None or not w:
            continue
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(key))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [1_000_000, 2])
def test_contamination_equals_brute_force(spark, odd, none, block):
    bench = spark.createDataFrame([(k, t, 1) for k, t in BENCH], "item_id long, text string, b int")
    got = decontaminate.contamination(odd, bench, block=block)
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    expected = [(i, *brute(t, BENCH)) for i, t, _ in ODD]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    top = next(r for r in got.collect() if r.doc_id == 1)
    assert (top.match_words, top.match_item, top.match_start, top["items"]) == (11, "1", 1, ["1"])
    kept = decontaminate.decontaminate(odd, bench, block=block)
    assert kept.schema == odd.schema and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t, _ in ODD if not brute(t, BENCH)[-1])
    assert decontaminate.contamination(none, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd, bench.limit(0)).collect())


def brute_match(text, items):
    """The longest run of words shared with an item (ties: first in the text, then smallest item): (words, item, start)."""
    own, best = words(text), (0, 0, "")
    for key, item in items:
        w = words(item)
        for i in range(len(own) if key is not None else 0):
            for j in range(len(w)):
                n = next((k for k, (a, b) in enumerate(zip(own[i:], w[j:])) if a != b), min(len(own) - i, len(w) - j))
                if n:
                    best = min(best, (-n, i, str(key)))
    return (-best[0], best[2], best[1]) if best[0] else (0, None, None)


@pytest.mark.parametrize("block", [1_000_000, 2])
def test_longest_match_of_every_copy(spark, block):
    rng = random.Random(5)
    draw = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    bench = [(k, draw(rng.choice([3, 12, 30]))) for k in range(8)] + [(8, "q " * 15), (9, "the"), (3, draw(14))]
    long = bench[0][1] + " z " + " ".join(w for _, t in bench for w in t.split()[:11])
    texts = [draw(rng.randint(0, 40)) for _ in range(30)] + [t for _, t in bench] * 3 + [long, long, "z " + long, "q " * 40, "z z", "the fox", None, ""]
    got = decontaminate.contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), spark.createDataFrame(bench, "item_id long, text string"), block=block)
    assert {r.doc_id: (r.match_words, r.match_item, r.match_start) for r in got.collect()} == {i: brute_match(t, bench) for i, t in enumerate(texts)}


def test_sql_equals_brute_force():
    con = duckdb.connect()
    docs = [(i, t) for i, t, _ in ODD if t is None or len(t) < 1000]
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(BENCH, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    got = con.sql(decontaminate.sql()).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").fetchall()
    assert sorted(map(str, got)) == sorted(str((i, *brute(t, BENCH))) for i, t in docs)
    found = con.sql(decontaminate.sql()).select("doc_id", "match_words", "match_item", "match_start").fetchall()
    assert sorted(map(str, found)) == sorted(str((i, *brute_match(t, BENCH))) for i, t in docs)


def test_equal_items_are_found_once_each(spark):
    """A thousand items of the same text cost its places once, and one block or many give the same rows."""
    text = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(k, text) for k in range(1000)] + [(5000, "w3 w4 w5")], "item_id long, text string").repartition(3)
    docs = spark.createDataFrame([(i, ("a b " + text + " c ") * (i % 3)) for i in range(200)], "doc_id long, text string")
    one, many = (sorted(map(str, decontaminate.contamination(docs, bench, block=b).collect())) for b in (1_000_000, 3000))
    assert one == many
    by = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (by[1].n_hit, by[1].n_items, by[2].n_hit, by[3].n_items, by[2].match_words, by[2].match_item, by[2].match_start) == (30, 1001, 60, 0, 30, "0", 2)
    tests = decontaminate.tests_of([(str(k), text) for k in range(1000)])
    shard = decontaminate.Shard.of([[w.encode() for w in ("a b " + text).split()]] * 50, tests)
    assert len(shard.matches(tests).places) == 21 * 50


def test_suffix_array_and_search():
    rng = np.random.default_rng(0)
    for _ in range(60):
        w = rng.integers(0, 4, rng.integers(0, 60)).astype(np.int32)
        runs = {p: (s := w[p:].tolist())[: s.index(0) if 0 in s else len(s)] for p in np.flatnonzero(w).tolist()}
        order = decontaminate.suffix_array(w)
        assert [runs[p] for p in order.tolist()] == sorted(runs.values())


def random_texts(n=120, seed=3):
    rng, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out[:n]


def brute_classes(pairs):
    """By row: (class_id, n_links, n_copies)."""
    texts: dict = {}
    for i, t in pairs:
        texts.setdefault(tuple(words(t)), []).append(i)
    keys = list(texts)
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set() for w in keys]
    links = [[j for j in range(len(keys)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(keys))]
    label = list(range(len(keys)))
    for _ in keys:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(keys))]
    ids = {c: min((i for k, key in enumerate(keys) if label[k] == c for i in texts[key] if i is not None), default=None) for c in set(label)}
    return {k: (ids[label[n]], len(links[n]), len(texts[k])) for n, k in enumerate(keys)}


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    pairs = [(i, t) for i, t, _ in ODD] + list(enumerate(random_texts(), 100))
    df = spark.createDataFrame(rows_of([(i, t, None) for i, t in pairs]), SCHEMA)
    expected = brute_classes(pairs)
    got = sorted(str(tuple(r)) for r in near.near_duplicates(df).collect())
    assert got == sorted(str((i, *expected[tuple(words(t))])) for i, t in pairs)
    assert any(e[1] > 1 for e in expected.values())


def test_near_sql_equals_brute_force():
    pairs = [(i, t) for i, t, _ in ODD if t is None or len(t) < 1000] + list(enumerate(random_texts(), 100))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(pairs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    expected = brute_classes(pairs)
    got = con.sql(near.sql()).select("doc_id", "class_id", "n_links", "n_copies").fetchall()
    assert sorted(map(str, got)) == sorted(str((i, *expected[tuple(words(t))])) for i, t in pairs)


def test_one_of_each_stays(spark, odd, none):
    kept = near.first_of_each(odd)
    assert kept.columns == odd.columns
    classes = brute_classes([(i, t) for i, t, _ in ODD])
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t, _ in ODD if i is None or classes[tuple(words(t))][0] == i)
    assert near.first_of_each(none).count() == 0 and near.near_duplicates(none).count() == 0


def test_one_row_of_each_class_stays(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    pairs = [(1, a), (5, a + " more"), (5, b), (None, c), (None, c), (None, a), (7, "x y"), (7, "x y"), (7, "X-y"), (8, c + " z"), (None, "q"), (None, "Q"), (None, "q"), (9, None), (9, None)]
    kept = near.first_of_each(spark.createDataFrame(rows_of([(i, t, None) for i, t in pairs]), SCHEMA).repartition(3))
    got = [(r.doc_id, tuple(words(r.text))) for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, tuple(words(a))), (5, tuple(words(b))), (8, tuple(words(c + " z"))), (7, (b"x", b"y")), (None, (b"q",)), (9, ())]))


@pytest.mark.parametrize("dense", [0, 10**9])
def test_similar_pairs_of_large_groups(monkeypatch, dense):
    """All pairs by either way to count; where only what they connect is wanted, far fewer are verified and the classes are the same."""
    monkeypatch.setattr(near, "DENSE", dense)
    monkeypatch.setattr(near, "CHUNK", 50)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, (3, 60)).astype(np.uint64)
    sets = []
    for i in range(240):  # one word in sixty or a third of them differ
        own = base[i % 3].copy()
        own[rng.choice(60, rng.choice([1, 2, 20]), replace=False)] = rng.integers(0, 2**63)
        sets.append(np.unique(own))
    counted, shared = [], near._shared

    def watched(*a):
        counts = shared(*a)
        return lambda some: counted.append(len(some)) or counts(some)

    monkeypatch.setattr(near, "_shared", watched)
    half, every = np.arange(120), np.arange(240)
    similar = {(i, j) for i in every for j in every[i + 1 :] if len(both := np.intersect1d(sets[i], sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - len(both)) - 1e-9}
    for left, right in ((every, every), (half, half + 120)):
        left, right = (left, left) if left is every else (left, right)
        expected = {(i, j) for i, j in similar if i in left and j in right}
        counted.clear()
        pairs = near.similar_pairs(sets, left, right, 0.8, 1e-7)
        total = sum(counted)
        assert set(zip(*map(np.ndarray.tolist, pairs))) == expected and len(expected) > 1000
        counted.clear()
        some = near.similar_pairs(sets, left, right, 0.8, 1e-7, connect=True)
        assert set(zip(*map(np.ndarray.tolist, some))) <= expected and sum(counted) < total / 2
        assert (near._roots(240, *some) == near._roots(240, *pairs)).all()


def test_posterior_bound():
    for n, least in zip(range(near.STEP, near.HASHES + 1, near.STEP), near.least_matches(0.8, 1e-7), strict=True):
        # numerically: the share of Beta(m+1, n-m+1) above the threshold
        x = (np.arange(20_000) + 0.5) / 20_000
        above = lambda m: float(((d := x**m * (1 - x) ** (n - m))[x >= 0.8]).sum() / d.sum())  # noqa: B023, E731
        assert above(least) >= 0.99e-7 and (least == 0 or above(least - 1) < 1.01e-7)
    assert comb(5, 2) == 10


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(500, 500 + i) for i in range(1, 30)] + [(7, 7)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    joined = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in near.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: label[x] for x in joined}
    assert near.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_word_hashes():
    texts = ["", "a", "A b a", "é É", "x" * 200_000, "ab " * 60_000, ODD[6][1] if isinstance(ODD[6][1], str) else ""]
    seen: dict = {}
    for t in texts:
        raw = t.encode()
        found = WORD.findall(raw.lower())
        hashes = word_hashes(raw)
        if all(len(w) < 4096 for w in found):
            assert len(hashes) == len(found)
            for w, h in zip(found, hashes.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_of_any_length_and_place_have_one_hash():
    seen: dict = {}
    for n in (4095, 4096, 4097, 65_535, 65_536, 70_000, 131_070, 300_000):
        word = "".join(random.Random(n).choices("ABCdef0123é", k=n))
        for before in ("", "a ", "-" * 65_534 + " ", "b c " * 20_000, "d" * 65_530 + " "):
            for after in ("", " ", " e", "." * 70_000):
                raw = (before + word + after).encode()
                found, hashes = WORD.findall(raw.lower()), word_hashes(raw).tolist()
                assert len(found) == len(hashes)
                for w, h in zip(found, hashes, strict=True):
                    assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_near_duplicates_with_long_words_equal_sql(spark):
    blob = "".join(random.Random(2).choices("abcdefghij0123456789", k=100_000))
    rest = " ".join(f"w{i}" for i in range(30))
    texts = ["a " + "x" * 100_000, "a  " + "x" * 100_000, "A, - " + "X" * 100_000, rest + " " + blob, "... " + rest + "  -- " + blob, rest + " v " + blob, blob + " " + rest]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(list(enumerate(texts)), columns=["doc_id", "text"]))
    expected = con.sql(near.sql()).select("doc_id", "class_id", "n_links", "n_copies").fetchall()
    got = near.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert (0, 0, 0, 3) in expected


def test_every_branch_of_the_join_equals_brute_force(spark, monkeypatch):
    """Narrow ranges of keys, refined and cut components, nodes and keys dealt over tasks, and joins that are no broadcasts."""
    for name, value in {"BLOCK": 3, "MOST": 4, "BLOCK_BYTES": 2000, "ENTRIES": 5, "SMALL": 0, "often": lambda total: 2}.items():
        monkeypatch.setattr(near, name, value)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        pairs = [(i, t) for i, t, _ in ODD] + list(enumerate(random_texts(60, 8), 100))
        pairs += pairs[-30:] * 3  # rows that repeat as a whole, in several tasks
        df = spark.createDataFrame(rows_of([(i, t, None) for i, t in pairs]), SCHEMA).repartition(3)
        expected = brute_classes(pairs)
        got = sorted(str(tuple(r)) for r in near.near_duplicates(df).collect())
    finally:
        spark.conf.set(key, before)
    assert got == sorted(str((i, *expected[tuple(words(t))])) for i, t in pairs)


def test_packed_keys_link_what_meets(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(near, "FLUSH", 300)
    keys = rng.integers(0, 200, (90, 5)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    nodes = [int(n) for n in rng.permutation(90) * 2**35]
    batches = []
    for part in (range(0, 30), range(30, 90)):
        bands = near._Bands()
        for i in part:
            bands.add(nodes[i], bytes([i]), keys[i])
            bands.add(nodes[i] + 1, bytes([i]), keys[i])  # a copy is met once
            if bands.n >= 100:
                batches.append(bands.flush())
        batches.append(bands.flush())
    for parts in (1, 7):
        rows = pa.Table.from_batches(batches)
        packs = rows.filter(pa.compute.is_valid(rows["pack"])).select(["span", "n", "pack"])
        if parts > 1:
            packs = pa.Table.from_batches(list(near._split(parts)(iter(packs.to_batches()))))
        met = pa.Table.from_batches(list(near._meet(iter(packs.sort_by("span").to_batches(max_chunksize=50)))))
        links = list(zip(met["a"].to_pylist(), met["b"].to_pylist())) + [x for x in zip(rows["a"].to_pylist(), rows["b"].to_pylist()) if x[0] is not None]
        label = {n: n for n in nodes}
        for _ in nodes:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        expected = {n: n for n in nodes}
        for _ in range(20):
            for k in np.unique(keys):
                own = [nodes[i] for i in np.flatnonzero((keys == k).any(1))]
                low = min(expected[n] for n in own)
                expected |= dict.fromkeys(own, low)
        assert label == expected


def test_sieve_lets_every_key_pass(spark):
    keys = spark.range(0, 3000, 3).selectExpr("xxhash64(id) as key")
    may = sieve(keys)
    got = {r.id for r in spark.range(3000).where(may(F.xxhash64("id"))).collect()}
    assert set(range(0, 3000, 3)) <= got and len(got) < 1300
    assert spark.range(10).where(sieve(keys.limit(0))(F.xxhash64("id"))).count() == 0


def test_longer_bands_keep_similar_texts_together():
    rng, apart = random.Random(9), 0
    for n in (40, 300):
        for _ in range(60):
            base = [rng.random().hex() for _ in range(n)]
            copy = list(base)
            copy[rng.randrange(n)] = "x"
            sets = [near.shingles(word_hashes(" ".join(w).encode())) for w in (base, copy, [rng.choice([w, "y"]) for w in base])]
            bands = [set(near.band_keys(near.signature(s, near._SECOND), near.LONG[1]).tolist()) for s in sets]
            similar = len(np.intersect1d(*sets[:2])) >= 0.8 * len(np.union1d(*sets[:2]))
            assert not similar or bands[0] & bands[1]
            apart += not bands[0] & bands[2]
    assert apart > 110


def prefix_links(sets):
    """All pairs of similarity 0.8 or more: every pair that shares one of the rarest shingles of either is compared."""
    sizes = [len(x) for x in sets]
    number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    rank = np.argsort(np.argsort(count, kind="stable"), kind="stable")[number]
    ends = np.r_[0, np.cumsum(sizes)]
    own = [np.sort(rank[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    index, links = {}, []
    for i in np.argsort(sizes, kind="stable"):
        prefix = own[i][: sizes[i] - -(-4 * sizes[i] // 5) + 1].tolist()
        for j in {j for g in prefix for j in index.get(g, ())}:
            both = len(np.intersect1d(own[i], own[j], assume_unique=True))
            if both >= 0.8 * (sizes[i] + sizes[j] - both) - 1e-9:
                links.append((i, j))
        for g in prefix:
            index.setdefault(g, []).append(i)
    return links


def test_recall_at_ten_thousand_documents(spark):
    """Every link and class of sf0.1, against all pairs that can be similar."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(tuple(words(r.text)), []).append(r.doc_id)
    keys = list(texts)
    links = prefix_links([near.shingles(word_hashes(b" ".join(w))) for w in keys])
    n_links, label = [0] * len(keys), [min(texts[w]) for w in keys]
    for i, j in links:
        n_links[i] += 1
        n_links[j] += 1
    for _ in range(20):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    expected = {i: (label[n], n_links[n], len(texts[w])) for n, w in enumerate(keys) for i in texts[w]}
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in near.near_duplicates(docs).collect()}
    assert got == expected and len(links) > 50
