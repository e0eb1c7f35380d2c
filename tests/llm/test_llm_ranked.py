"""Ranked search against scores computed document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from recordloom.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=50):
    """Sorted (item, rank, doc, score) over (id, text) rows."""
    counts = [(i, Counter(tokens(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    holders = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for t in set(tokens(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=50, **options):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in ranked.ranked_search(left, right, k, **options).collect()], key=str)


def corpus(seed, size, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(size)]


@pytest.mark.parametrize("shard, first, at_once", [(4096, 16, 1 << 22), (16, 2, 40), (7, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, shard, first, at_once):
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked, "FIRST_ROUND", first)
    monkeypatch.setattr(ranked, "POSTINGS_AT_ONCE", at_once)
    docs = corpus(1, 400)
    items = [(i, t) for i, (_, t) in enumerate(corpus(2, 12))]
    for k in (1, 5, 50):
        assert run(spark, docs, items, k) == brute_force(docs, items, k)


def test_copies_tie_by_id(spark):
    docs = [(500 - i, "same words here") for i in range(300)] + [(600, "same words here and more")]
    assert run(spark, docs, [(1, "Words HERE")]) == brute_force(docs, [(1, "words here")])


def test_odd_rows(spark):
    docs = [(None, "one two"), (1, None), (2, ""), (3, "... !"), (4, "ONE two two"), (4, "ONE two two"), (4, "one"), (5, "Éa éa one"), (6, "x " * 200_000 + "one")]
    items = [(1, "one TWO"), (1, "one TWO"), (1, "éa"), (2, None), (3, "?"), (4, "unknown"), (None, "x")]
    assert run(spark, docs, items) == brute_force(docs, items)
    assert run(spark, docs, items, block_bytes=300) == brute_force(docs, items)
    assert run(spark, docs[:0], items) == [] == run(spark, docs, items[:0])
    clash = spark.createDataFrame([(1, "one", "a", "b")], "doc_id int, text string, score string, rank string")
    asked = spark.createDataFrame([("i", "one", 5)], "item_id string, text string, doc_id int")
    out = ranked.ranked_search(clash, asked)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r) for r in out.collect()] == [("i", 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // 3000))]


def test_range_maxima():
    rng = np.random.default_rng(6)
    n, at, term = np.full(50, 9), np.tile(np.arange(50), 3), np.repeat([0, 1, 2], 50)
    shard = ranked.Shard(n, at, term, rng.integers(1, 40, 150), np.array([5, 900, 40]), 100, 900)
    for _ in range(300):
        t = int(rng.integers(3))
        a, b = sorted(rng.choice(51, 2, replace=False) + 50 * t)
        assert shard.maxima(np.array([a]), np.array([b]))[0] == a + int(np.argmax(shard.impacts[a:b]))


def test_shards_are_cut_short(monkeypatch):
    """A floor that few documents reach leaves most of them unscored."""
    rng = np.random.default_rng(7)
    size = 2_000
    lists = [np.sort(rng.choice(size, 200, replace=False)) for _ in range(8)]
    shard = ranked.Shard(np.full(size, 50), np.concatenate(lists), np.repeat(np.arange(8), 200), np.ones(1_600, np.int64), np.full(8, 2_000), size, 50 * size)
    scored = []
    plain = ranked.np.searchsorted
    monkeypatch.setattr(ranked.np, "searchsorted", lambda a, v, *rest: (scored.append(np.size(v)), plain(a, v, *rest))[1])
    all_terms = [np.arange(8)]
    item, doc, score = ranked.search(shard, all_terms, np.array([0]), 5)
    best = np.sort(score)[-5:]
    without = sum(scored)
    scored.clear()
    again = ranked.search(shard, all_terms, np.array([best[0]]), 5)[2]
    assert np.sort(again)[-5:].tolist() == best.tolist()
    assert sum(scored) <= without
