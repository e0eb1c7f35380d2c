"""The registered queries against their SQL, brute force or held-out labels, on the smallest tables."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, differences

from recordloom.llm import jaccard
from recordloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NATIVE = ["op1_license_scan", "op6_line_dedup", "op7_decontaminate", "op9_secret_scan"]


@pytest.mark.parametrize("name", ORACLE)
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("name, label, least", [("op2_quality_classifier", "quality", 0.9), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    right = Counter((r[label], r.predicted == r[label]) for r in rows)
    recalls = [right[c, True] / (right[c, True] + right[c, False]) for c in (0, 1)]
    assert np.mean(recalls) >= least


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute_force(texts):
    """Class and number of links of each (id, text)."""
    sets, holders = {i: grams(t) for i, t in texts}, defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    root, links = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for g in s for j in holders[g] if j > i)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (find(i), links[i]) for i in sets}


def test_jaccard_join_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_copies(docs).collect()} == want


def test_jaccard_join_of_a_large_group(spark, monkeypatch):
    """Many near copies and sets that share tokens: nodes are split, and blocks meet."""
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(240):
        words = list(base) if i < 120 else base[:25] + [f"v{x}" for x in rng.integers(0, 10_000, 35)]
        words[int(rng.integers(30, 60))] = f"u{i}"
        texts.append((i, " ".join(words)))
    texts += [(300 + i, texts[i][1].upper()) for i in range(5)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_copies(df).collect()} == brute_force(texts)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    out = corpus_pipeline.run(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_copies", "decontaminate", "pieces"]
    assert len({r.doc_id for r in out}) == len(out) > 0.6 * len(docs)
    kept = {r.doc_id: r.text for r in out}
    classes = brute_force(kept.items())
    assert all(c == (i, 0) for i, c in classes.items())  # no near copies are left
    window = lambda t: {tuple(w[i : i + 10]) for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())] for i in range(len(w) - 9)}
    leaked = set().union(*[window(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert not any(window(t) & leaked for t in kept.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum(labels.get(i) == 0 for i in kept) <= 3
    assert all(r.n_tokens == len(r.ids) and r.ids[0] == 1 and r.ids[-1] == 2 for r in out)
