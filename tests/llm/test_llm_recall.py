"""The stated loss of the near copies' tree, walked as the code splits it."""

import math

from recordloom.llm import jaccard


def lost(runs, splits):
    """Of a pair at the threshold, with ``splits`` levels below the root."""
    below = 0.0
    for _ in range(splits):
        below = (1 - 0.8 * (1 - below)) ** jaccard.CHOSEN
    return (1 - 0.8 * (1 - below)) ** runs


def test_recall_holds_at_any_depth():
    runs = jaccard.root_runs(jaccard.RECALL)
    sketches = sum(math.comb(128, k) * 0.8**k * 0.2 ** (128 - k) for k in range(math.ceil(jaccard.LIKELY * 128)))
    assert 7.5e-8 < sketches < 7.7e-8
    assert max(lost(runs, d) for d in range(jaccard.DEEPEST)) + sketches <= 1 - jaccard.RECALL
    assert max(lost(runs - 1, d) for d in range(jaccard.DEEPEST)) + sketches > 1 - jaccard.RECALL


def test_the_root_chooses_as_many(spark, monkeypatch):
    asked, leaves = [], jaccard.leaves
    monkeypatch.setattr(jaccard, "leaves", lambda sketches, runs: asked.append(runs) or leaves(sketches, runs))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id bigint, text string")
    jaccard.near_copies(docs).collect()
    assert lost(asked[0], jaccard.DEEPEST - 1) <= 1 - jaccard.RECALL
