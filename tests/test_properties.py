"""Random inputs against plain Python statements of the same rules."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordloom.functions import cleaning as c
from recordloom.operators.dedup import keep_latest
from recordloom.operators.members import members, union_members

SPACES = " \t\n 　"


def _texts(rng, alphabet, n, longest):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)] + [None]


def _zip(text):
    if text is None:
        return None
    token = text.strip(c.WHITESPACE).upper()
    if token in ("N/A", "NA"):
        return None
    if token == "ANONYMOUS":
        return "Anonymous"
    if len(text) in (5, 9) or (len(text) == 10 and re.match(r"[0-9]{5}-[0-9]{4}", text)):
        return text
    return None


@pytest.mark.parametrize("alphabet", ["0123456789-", "nNaA/ \t", "01-é" + SPACES])
def test_zip(values, alphabet):
    texts = _texts(random.Random(alphabet), alphabet, 1500, 13)
    texts += ["".join(random.Random(i).choice("012345-") for _ in range(10)) for i in range(300)]
    texts += [f"{a}anonymous{b}" for a in SPACES for b in SPACES]
    assert values(c.clean_zip, texts) == [_zip(t) for t in texts]


def test_borough(values):
    rng = random.Random(2)
    spellings = {s: label for label, group in c.BOROUGH_SPELLINGS.items() for s in group}
    texts = []
    for s in [*spellings, "NOWHERE", ""]:
        for _ in range(40):
            mixed = "".join(ch.lower() if rng.random() < 0.5 else ch for ch in s)
            texts.append(rng.choice(["", " ", "\t", " "]) + mixed + rng.choice(["", " ", "\n", "x"]))
    expected = [spellings.get(t.strip(c.WHITESPACE).upper()) for t in texts]
    assert values(c.clean_borough, texts) == expected


def test_trim(values):
    texts = _texts(random.Random(3), "ab" + c.WHITESPACE, 1500, 9)
    assert values(c.trim_all, texts) == [t if t is None else t.strip(c.WHITESPACE) for t in texts]


def test_latest_with_a_hot_key(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, None, *range(2, 200)]), rng.choice([None, *range(50)]), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, t int, i int").repartition(16)
    got = {(r.k, r.i) for r in keep_latest(df, "k", [F.col("t").desc_nulls_last()]).collect()}
    best = {}
    for k, t, i in rows:
        rank = (t is None, -(t or 0), i)
        if k not in best or rank < best[k]:
            best[k] = rank
    assert got == {(k, rank[2]) for k, rank in best.items()}


def test_members_are_sets(spark):
    rng = random.Random(5)
    a = [(rng.choice([None, "", "x", "y"]), rng.choice([None, 1, 2])) for _ in range(500)]
    b = [(rng.choice([None, "z", "y"]), rng.choice([None, 2, 3])) for _ in range(500)]
    one, two = (members(spark.createDataFrame(d, "s string, n int"), s=F.col("s"), n=F.col("n")) for d in (a, b))
    assert Counter(map(tuple, union_members(one, two).collect())) == Counter(set(a) | set(b))
    kept = members(spark.createDataFrame(a, "s string, n int"), ("s",), s=F.col("s"))
    assert {r.s for r in kept.collect()} == {s for s, _ in a} - {None}
