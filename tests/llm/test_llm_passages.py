"""Repeated passages in otherwise different documents: nothing of two lines or more stays a second time."""

import corpus_pipeline
import numpy as np
import pytest

from recordloom.llm import lines

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def by_hand(texts):
    """Kept text of each (id, text): pairs of neighbouring lines that are not blank, first occurrences stay."""
    seen, out = set(), {}
    for i, text in sorted(texts):
        parts, gone = text.split("\n"), set()
        at = [k for k, line in enumerate(parts) if line.strip()]
        for a, b in zip(at, at[1:]):
            pair = tuple(parts[a : b + 1])
            if pair in seen:
                gone |= set(range(a, b + 1))
            seen.add(pair)
        out[i] = "\n".join(line for k, line in enumerate(parts) if k not in gone)
    return out


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8, 10, 20])
def test_passage_in_two_contexts(spark, n):
    rows = []
    for k in range(30):
        passage = [f"passage {k} line {j}" for j in range(n)]
        for copy in range(2):
            rows.append((2 * k + copy, "\n".join([f"{k} {copy} before {j}" for j in range(5)] + passage + [f"{k} {copy} after {j}" for j in range(5)])))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = {r.doc_id: r for r in corpus_pipeline.without_repeated_lines(spark, docs, "").collect()}
    for i, text in rows:
        whole = text.split("\n")
        assert kept[i].text.split("\n") == (whole[:5] + whole[-5:] if i % 2 else whole)
        assert kept[i].n_chars == len(kept[i].text)


def test_passages_by_hand(spark):
    rng = np.random.default_rng(7)
    words = ["a", "b", "c", "", " ", "d", "e", "f"]
    texts = [(i, "\n".join(rng.choice(words, rng.integers(1, 9)))) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], SCHEMA)
    out = {r.doc_id: r for r in lines.drop_repeated_passages(docs).collect()}
    want = by_hand(texts)
    for i, text in texts:
        untouched = out[i].lines_removed == 0
        assert out[i].text == (text if untouched else want[i]) and (not untouched or want[i] == text)
    left = {i for i, t in want.items() if t.strip() or t == dict(texts)[i]}
    assert {r.doc_id for r in lines.drop_repeated_passages(docs, drop_emptied=True).collect()} == left
    lines_of = lambda found: {line for t in found for line in t.split("\n") if line.strip()}
    assert lines_of(want.values()) == lines_of(t for _, t in texts)


def test_odd_passage_rows(spark):
    rows = [(1, None), (2, ""), (3, "x\ny"), (3, "x\ny"), (4, "x\ny"), (None, "x\nz"), (5, "one")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    out = [(r.doc_id, r.text) for r in lines.drop_repeated_passages(docs).collect()]
    assert sorted(out, key=str) == sorted([(1, None), (2, ""), (3, "x\ny"), (3, "x\ny"), (4, ""), (None, "x\nz"), (5, "one")], key=str)
    assert lines.drop_repeated_passages(docs.limit(0)).count() == 0


@pytest.mark.parametrize("divisor", [2, 3])
def test_chunks_settle_what_lies_inside_them(spark, divisor):
    """Repeated chunks come first; only pairs that they leave are looked at one by one, and the outcome is by hand's."""
    rng = np.random.default_rng(11)
    shared = [f"shared {j}" if j % 7 else "" for j in range(60)]
    texts = [(i, "\n".join([f"{i} head", *shared[: int(rng.integers(30, 60))], f"{i} tail"])) for i in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [*texts, texts[2]]], SCHEMA)
    keyed = lines.keyed(docs)
    settled = lines._in_repeated_chunks(keyed, divisor)
    assert settled.count() == 5
    pairs = {(r.doc_id, p >> 32, p & 0xFFFFFFFF) for r in keyed.join(settled, (keyed.k1 == settled.ck1) & (keyed.k2 == settled.ck2)).collect() for p in r.settled}
    assert len(pairs) > 30
    whole = dict(texts)
    earlier = lambda i, passage: any(f"\n{passage}\n" in f"\n{whole[j]}\n" for j in range(i))
    for i, a, b in pairs:
        assert earlier(i, "\n".join(whole[i].split("\n")[a : b + 1]))
    want = by_hand(texts)
    assert {r.doc_id: r.text for r in lines.drop_repeated_passages(docs, divisor=divisor).collect()} == want
