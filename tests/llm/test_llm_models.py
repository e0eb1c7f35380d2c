"""The fitted models' scores against loops over their rules, filters and texts."""

import math
import random

import numpy as np
import pytest

from recordloom.llm import quality, toxicity
from recordloom.llm.common import read

SF = "/root/testdata/sf0.001"


def test_rules_by_loops(spark):
    """Every conjunction is tried on every document's statistics."""
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    model = quality.learn(docs, labels)
    assert len(model.rules) > 3 and max(len(r.bounds) for r in model.rules) > 1
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, model).collect()}
    assert len(scores) == docs.count()
    for row in quality.with_statistics(docs).collect():
        total = model.bias
        for rule in model.rules:
            if all((row[name] > value) if above else (row[name] <= value) for name, above, value in rule.bounds):
                total += rule.weight
        assert scores[row.doc_id] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-12)


def test_tree_paths_are_conjunctive_rules():
    """Two thresholds on two statistics: the fit finds the corner, whatever a third one says."""
    rng = np.random.default_rng(1)
    x = rng.random((2_000, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.4)).astype(float)
    model = quality.fit(["a", "b", "c"], x, y)

    def score(row):
        held = [r.weight for r in model.rules if all((row["abc".index(n)] > v) == above for n, above, v in r.bounds)]
        return 1 / (1 + math.exp(-model.bias - sum(held)))

    fresh = rng.random((500, 3))
    right = [(score(row) >= 0.5) == (row[0] > 0.6 and row[1] <= 0.4) for row in fresh]
    assert np.mean(right) > 0.97


def slow_margin(network, text):
    words = toxicity.find_words(text.lower())
    vectors = [sum(network.embedding[b] for b in toxicity.buckets(w)) for w in words]
    total, position = network.bias, 0
    for span, f in network.filters.items():
        for k in range(toxicity.FILTERS):
            values = [sum(float(vectors[i + j] @ f[j][:, k]) for j in range(span)) for i in range(len(words) - span + 1)]
            pooled = max(values) if values else 0.0
            total += max(pooled + float(network.offsets[position]), 0.0) * float(network.weights[position])
            position += 1
    return total - float(network.margins[toxicity.language(words)])


@pytest.fixture(scope="module")
def network():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "and", "good", "fine", "word", "bad", "awful"][: 6 + i % 2 * 2]) for _ in range(rng.randint(4, 40))) for i in range(200)]
    return toxicity.fit(texts, np.array([float("bad" in t or "awful" in t) for t in texts]), epochs=2)


@pytest.mark.parametrize("chunk", [1 << 16, 8, 5, 4])
def test_convolution_by_loops(network, monkeypatch, chunk):
    """Texts in one piece and in many, down to pieces hardly wider than the filters."""
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", chunk)
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4, 5, 7, 8, 9, 40, 100):
        text = " ".join(rng.choice(["the", "Bad", "awful", "word", "über", "x1", "of"]) for _ in range(n))
        assert network.margin(text) == pytest.approx(slow_margin(network, text), abs=1e-4)


def test_missing_a_toxic_text_weighs_more():
    margins = np.array([*np.arange(100) / 100, 0.905, *(1 + np.arange(20) / 100)])
    truth = np.array([False] * 100 + [True] * 21)
    assert 0.9 < toxicity._threshold(margins, truth, 0.0) <= 1.0  # 9 false alarms cost more than one missed
    truth[-21] = True
    margins[100] = 0.985
    assert toxicity._threshold(margins, truth, 0.0) < 0.985  # 1 false alarm does not
    assert toxicity._threshold(margins[:50], truth[:50], 5.0) == 5.0
