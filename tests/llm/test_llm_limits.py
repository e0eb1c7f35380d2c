"""Texts with very many matches, and components of any finite size."""

import math
import re
import time

from recordloom.llm import innerproduct, secrets


def test_very_many_secrets_in_one_text(spark):
    text = " ".join(f"password=abcdefgh{i:06d}" for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "token=short token=long_enough"), (3, None)], "doc_id bigint, text string")
    rules = (secrets.RULES[0],)
    secrets.secret_spans(docs.filter("doc_id > 1"), rules).collect()  # compiled beforehand
    began = time.perf_counter()
    found = {r.doc_id: r.found for r in secrets.secret_spans(docs, rules).collect()}
    assert time.perf_counter() - began < 15
    want = [m.span() for m in re.finditer(r"password=[a-z0-9]+", text)]
    assert [(s.start, s.stop) for s in found[1]] == want
    assert [(s.start, s.stop) for s in found[2]] == [(12, 29)] and found[3] == []


def test_running_sums_at_the_ends_of_runs(spark):
    for n in (1, secrets.RUN - 1, secrets.RUN, secrets.RUN + 1, 3 * secrets.RUN):
        text = "x".join(f" É token: 'value{i}value' " for i in range(n))
        found = secrets.secret_spans(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), (secrets.RULES[0],)).first().found
        assert [(s.start, s.stop) for s in found] == [m.span() for m in re.finditer(r"token: '[a-z0-9]+", text)]


def _search(spark, rows, k=5, every=20, shard_rows=4096):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    return innerproduct.top_inner_products(df, lambda i: i % every == 0, k=k, shard_rows=shard_rows).collect()


def test_large_components(spark):
    values = [0.5, 1e9, -1e9, 2.0**60, 1e18, 1e300, -1e300, 3.0, 1e-300, 0.25]
    rows = [(i, [v, 1.0, -values[-1 - i]], "x") for i, v in enumerate(values)]
    x = {i: [math.floor(64 * c) if abs(c) < 2**50 else int(c) * 64 for c in v] for i, v, _ in rows}
    for shard_rows in (4096, 3):
        found = _search(spark, rows, 4, 1, shard_rows)
        for q in x:
            scores = {i: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x[q], x[i])))) for i in x if i != q}
            want = sorted((-s, i) for i, s in scores.items())[:4]
            assert [(r.score, r.vec_id) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == [(-s, i) for s, i in want]


def test_ids_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0], "x"), (0, [0.0, 1.0], "x"), (1, [2.0, 1.0], "x"), (2, [0.0, 5.0], "x"), (2, [7.0, 0.0], "x"), (0, [1.0, 0.0], "again")]
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in _search(spark, rows))
    one, other = [(2, 7 * 64 * 64), (1, 2 * 64 * 64), (2, 0)], [(2, 5 * 64 * 64), (1, 64 * 64), (2, 0)]
    assert found == sorted((0, r, i, s) for ranks in (one, other) for r, (i, s) in enumerate(ranks, 1))
    out_of_range = _search(spark, [(0, [1e308], "x"), (20, [1.0], "x"), (40, [2.0], "x"), (60, [float("inf")], "x")])
    assert sorted((r.query_id, r.vec_id) for r in out_of_range) == [(20, 40), (40, 20)]
