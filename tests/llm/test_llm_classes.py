"""Classes without links: the same as with them, and rows that grow with a group and not with its square."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_queries import brute_force

from recordloom.llm import jaccard


def texts_of(n, seed, changed=3, words=80):
    """Near copies of one text, each with some words of its own."""
    rng = np.random.default_rng(seed)
    base = [f"b{seed}w{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.integers(0, words, int(rng.integers(1, changed + 1))):
            own[int(at)] = f"u{seed}x{i}"
        out.append(" ".join(own))
    return out


def classes(df, **options):
    return {(r.doc_id, r.class_id) for r in jaccard.near_copies(df, **options).collect()}


@pytest.mark.parametrize("small, block, exact, size", [(8, 16, 16, 8 << 20), (8, 2048, 5, 8 << 20), (1024, 2048, 512, 3_000)])
def test_same_classes_as_by_brute_force(spark, monkeypatch, small, block, exact, size):
    for name, value in (("SMALL", small), ("BLOCK", block), ("EXACT_BLOCK", exact), ("EXACT_BYTES", size)):
        monkeypatch.setattr(jaccard, name, value)
    texts = [*texts_of(60, 1), *texts_of(30, 2, 6), *texts_of(20, 3, 9, 40), "alone in its class of one text only", None, ""]
    rows = list(enumerate([*texts, *texts[:3]]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(i, c) for i, (c, _) in brute_force(rows).items()}
    assert len({c for _, c in want}) > 6
    assert classes(df, count=False) == want
    if block == 16:
        assert {r.doc_id for r in jaccard.keep_one(df).collect()} == {c for _, c in want}


def test_rows_grow_with_a_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", 32)
    rows = {}
    made = []
    plain = jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda df: (made.append(df.count()), plain(df))[1])
    for n in (100, 400):
        made.clear()
        df = spark.createDataFrame(list(enumerate(texts_of(n, 4, 1, 160))), "doc_id bigint, text string")
        assert len({c for _, c in classes(df, count=False)}) == 1
        rows[n] = sum(made) / n
    assert rows[400] < 1.3 * rows[100]
