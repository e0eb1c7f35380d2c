"""Whitening against a plain computation over distinct integer vectors."""

import math

import numpy as np
import pytest

from recordloom.llm import whitening
from recordloom.llm.queries import QUERIES


def brute_force(rows, components=16, counts=False):
    """(rows as (id, x), n, sums, whitened axes and eigenvalues) with loops over Python integers."""
    valid = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in valid]
    fitted = [x for _, x in xs] if counts else sorted({x for _, x in xs})
    n, d = len(fitted), len(fitted[0])
    sums = [sum(x[j] for x in fitted) for j in range(d)]
    centred = [[(n * x[j] - sums[j]) / n for j in range(d)] for x in fitted]
    v = np.array([[sum(c[a] * c[b] for c in centred) / n for b in range(d)] for a in range(d)])
    values, axes = np.linalg.eigh(v)
    return xs, n, sums, axes[:, ::-1][:, :components], values[::-1][:components], np.trace(v)


def check(out, rows, **options):
    xs, n, sums, axes, values, trace = brute_force(rows, **options)
    assert len(out) == len(xs) * len(values)
    by_id = {(r.vec_id, r.component): r for r in out}
    signs = np.ones(len(values))
    for k in range(len(values)):
        for i, x in xs:
            row = by_id[i, k + 1]
            assert row.n == n
            assert row.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            assert row.explained == pytest.approx(values[k] / trace, rel=1e-9)
            assert row.identity_error < 1e-9
            want = sum((n * a - s) / n * axes[j, k] for j, (a, s) in enumerate(zip(x, sums))) / math.sqrt(values[k])
            if abs(want) > 1e-3 and abs(row.whitened - signs[k] * want) > 1e-6:
                assert signs[k] == 1  # one sign for all rows
                signs[k] = -1
            assert row.whitened == pytest.approx(signs[k] * want, abs=1e-6)


@pytest.mark.parametrize("counts", [False, True])
def test_equals_brute_force(spark, counts):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, v)) for v in rng.normal(0, [1, 5, 0.5, 20], (40, 4))]
    rows = [(i, v) for i, v in enumerate([*vectors, *[vectors[0]] * 30, *vectors[1:4]])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    check(whitening.whiten(df, 3, "counts" if counts else "one").collect(), rows, components=3, counts=counts)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, sf).collect(), rows)


def test_blocks_of_rows_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.normal(0, 3, (50, 3)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(7)
    monkeypatch.setattr(whitening, "CHUNK", 4)
    check(whitening.whiten(df).collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a"), (2, [3.0, -2.0], "b"), (2, [3.0, -2.0], "c"), (None, [0.0, 1.0], "d"), (4, None, "e"), (5, [nan, 1.0], "f"),
            (6, [inf, 1.0], "g"), (7, [None, 1.0], "h"), (8, [], "i"), (9, [1.0, 2.0, 3.0], "j")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n string").withColumnRenamed("n", "whitened")
    out = whitening.whiten(df).collect()
    assert sorted((r.vec_id or -1, r.component) for r in out) == [(-1, 1), (-1, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2), (9, 1), (9, 2), (9, 3)]
    assert {r.n for r in out if r.vec_id != 9} == {3}
    alone = [r for r in out if r.vec_id == 9]  # a length of its own, without variance
    assert {(r.n, r.deviation, r.whitened, r.explained) for r in alone} == {(1, 0, None, 0.0)}
    assert all(r.identity_error < 1e-9 for r in out)
    assert whitening.whiten(df.limit(0)).collect() == []
    one = whitening.whiten(df.limit(1)).collect()
    assert {(r.whitened, r.identity_error) for r in one} == {(None, None)}


def test_large_components(spark):
    """Deviations beyond a long are NULL, and those that need more than 64 bits on the way are exact."""
    rows = [(1, [1e9, 0.0]), (2, [5.0, 1.0]), (3, [2.0, 7.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.deviation for r in out} == {None}
    rows = [(1, [2e6, 0.0]), (2, [5.0, 1.0])]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 1).collect(), rows, components=1)
    with pytest.raises(Exception, match="does not fit"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id bigint, embedding array<double>")).collect()


def test_beyond_the_broadcast_budget(spark, monkeypatch):
    from recordloom.llm import whitening as module

    plain = module.sized_join
    monkeypatch.setattr(module, "sized_join", lambda *a, **b: plain(*a, **b, budget=0, rows_per_task=5))
    rows = [(i, [float(i % 3), float(i % 5), 1.5 * (i % 2)]) for i in range(60)] + [(100 + i, [9.0, 9.0, 9.0]) for i in range(40)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect(), rows)
