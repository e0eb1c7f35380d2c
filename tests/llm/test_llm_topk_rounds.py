"""Top-k search in rounds: what is sent and scored, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import innerproduct


def whole(vector):
    return [int(np.floor(64 * c)) if abs(c) < 2**50 else int(c) * 64 for c in vector]


def brute_force(rows, every, k):
    """Best (score, id) of each query row, as sorted lists."""
    x = [(i, whole(v)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows)]
    out = {}
    for n, (q, a) in enumerate(x):
        if q % every == 0:
            scores = [(max(-(2**63), min(2**63 - 1, sum(p * r for p, r in zip(a, b)))), i) for i, b in x if i != q and len(a) == len(b)]
            out[q, n] = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
    return out


def searched(spark, rows, every, k, shard_rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for r in innerproduct.top_inner_products(df, lambda i: i % every == 0, k=k, shard_rows=shard_rows).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: [(s, i) for _, s, i in sorted(best)] for q, best in found.items()}


def compare(spark, rows, every=1, k=5, shard_rows=16):
    want = {q: best for (q, _), best in brute_force(rows, every, k).items() if best}
    assert searched(spark, rows, every, k, shard_rows) == want


def test_shards_and_blocks_are_not_sent_in_pairs(spark, monkeypatch):
    """Once a row held a block and a shard: with many shards Arrow batches of them outgrew a worker."""
    sent, real = [], innerproduct._searched

    def counted(dealt, *args):
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in dealt.dtypes if t == "binary"), F.lit(0)).cast("bigint")
        sent.append(dealt.agg(F.count("*"), F.sum(size), F.max(size)).first())
        return real(dealt, *args)

    monkeypatch.setattr(innerproduct, "_searched", counted)
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(0, 0.3, (1024, 16)).tolist())]
    compare(spark, rows, shard_rows=8)  # 128 shards
    assert sum(n for n, _, _ in sent) < 2_000
    assert sum(b for _, b, _ in sent) < 3_000_000
    assert max(m for _, _, m in sent) < 10_000


def test_components_of_all_widths_and_any_ids(spark):
    rng = np.random.default_rng(2)
    size = rng.choice([0.5, 100, 1e6, 1e10], 300)[:, None]
    rows = [(int(i) - 150, v) for i, v in enumerate((rng.normal(0, 1, (300, 5)) * size).tolist())]
    rows += [(7, [0.25]), (9, [-0.0]), (8, [2.0]), (10, [0.0]), (7, [0.25])]
    rows = [(i + (1000 if len(v) == 1 else 0), v) for i, v in rows]
    compare(spark, rows, every=3, k=4)


def test_scores_that_are_equal_as_floats(spark):
    """Beyond 2^53 the id decides only between scores that are equal as integers."""
    big = 2.0**30
    rows = [(0, [big, 1.0, 0.0])] + [(i, [big, i / 64, 0.0]) for i in range(1, 40)] + [(i, [big, 5.0, i / 64]) for i in range(40, 60)]
    for shard_rows in (4, 4096):
        compare(spark, rows, every=20, k=3, shard_rows=shard_rows)


def test_many_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    sparse = np.where(rng.random((400, 12)) < 0.04, 1.0, 0.0)
    rows = [(int(i), v) for i, v in zip(rng.permutation(400), sparse.tolist())]
    compare(spark, rows, every=10, k=6, shard_rows=32)


@pytest.mark.parametrize("k", [1, 20])
def test_nodes_out_of_reach_are_not_scored(monkeypatch, k):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 40, (16, 8))
    x = np.round(centres[rng.integers(0, 16, 8192)] + rng.normal(0, 1, (8192, 8))).clip(-128, 127).astype(np.int8)
    ids, shards = rng.permutation(8192), []
    for part in np.split(np.arange(8192), 2):
        tree = innerproduct.BallTree(x[part].astype(float), 1)
        order = part[tree.order]
        parts = (x[order], np.ones(len(part), np.int32), ids[order], tree.nodes, tree.centres, tree.radii)
        shards.append(innerproduct.Shard(8, 1, *(p.tobytes() for p in parts)))
    pairs, real = [], innerproduct.Search.tile
    monkeypatch.setattr(innerproduct.Search, "tile", lambda self, s, active, q, rows, at: (pairs.append(len(active) * len(rows)), real(self, s, active, q, rows, at)))
    asked = x[:200]
    search = innerproduct.Search(ids[:200], asked, np.full(200, -np.inf), np.full(200, innerproduct.LAST_ID), np.ones(200, int), k)
    for shard in shards:
        search.shard(shard)
    at, found, scores = search.best()
    for i in range(200):
        score = x.astype(int) @ asked[i].astype(int)
        want = [n for n in np.lexsort((ids, -score)) if ids[n] != ids[i]][:k]
        assert found[at == i].tolist() == ids[want].tolist() and scores[at == i].tolist() == score[want].tolist()
    assert sum(pairs) < 0.5 * 200 * 8192
