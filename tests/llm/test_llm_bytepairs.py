"""Byte-level BPE against the tiktoken library, and its boundaries against the split pattern."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from recordloom.llm import bytepairs
from recordloom.llm.queries import QUERIES

ALPHABET = "''''  \n\tstmdrvelabZ019.!é漢🙂　 \u0085\x1c<|>"


@pytest.fixture(scope="module")
def ranks():
    with open(bytepairs.ranks_path(), "rb") as f:
        return bytepairs.Ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return np.frombuffer(bytepairs.library_kinds(), np.uint8)


def ids(packed):
    return np.frombuffer(packed, np.int32).tolist()


def test_random_texts(ranks, library, table):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    found = ranks.encode([t.encode() for t in texts], table)
    assert [ids(f) for f in found] == [library.encode_ordinary(t) for t in texts]
    assert [ranks.decode(np.array(ids(f), np.int64)).decode() for f in found] == texts


def test_every_code_point(ranks, library, table):
    text = "".join(f"a{chr(c)}a {chr(c)}1" for c in [*range(0xD800), *range(0xE000, 0x110000)])
    assert ids(ranks.encode([text.encode()], table)[0]) == library.encode_ordinary(text)


def test_windows_do_not_matter(table):
    rng = random.Random(2)
    for size in (1, 2, 5, 300):
        data = "".join(rng.choice(ALPHABET) for _ in range(3_000)).encode() + bytes([bytepairs.SEPARATOR])
        assert bytepairs.boundaries(data, table, size).tolist() == bytepairs.boundaries(data, table).tolist()


def test_composition_is_associative():
    _, product, order, _ = bytepairs.automaton()
    n = range(len(order))
    assert all(product[product[a, b], c] == product[a, product[b, c]] for a in n for b in n for c in n)


@pytest.mark.parametrize("word", ["ab" * 40, "x" * 500, "abcdefghij" * 30, "é" * 200, "z"])
def test_long_words(ranks, library, table, word):
    assert ids(ranks.encode([word.encode()], table)[0]) == library.encode_ordinary(word)


def test_cache_generations(ranks, library, table, monkeypatch):
    monkeypatch.setattr(bytepairs, "CACHED", 3)
    texts = ["one two three four five six seven one two", "seven six five"] * 3
    assert [ids(f) for f in ranks.encode([t.encode() for t in texts], table)] == [library.encode_ordinary(t) for t in texts]


def test_odd_rows(spark, library):
    """NULL, empty, long and repeated texts, blanks alone, and columns named like the added ones."""
    texts = [None, "", " ", "\n\n", "word " * 300_000, "it's", "it's", "don't'll 'r"]
    rows = [(i % 6, t, "kept", "lost") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, other string, ids string")
    out = bytepairs.encode(df, bytepairs.ranks_path(), ["n_tokens", "ids", "ends", "decoded"])
    assert out.columns == ["doc_id", "text", "other", "n_tokens", "ids", "ends", "decoded"]
    for row in out.collect():
        want = library.encode_ordinary(row.text or "")
        data = (row.text or "").encode()
        assert row.ids == want and row.n_tokens == len(want) and row.decoded == (row.text or "") and row.other == "kept"
        spans = zip([0, *row.ends], row.ends)
        assert [data[a:b] for a, b in spans] == [library.decode_single_token_bytes(i) for i in want]
    assert sorted(r.text or "" for r in out.collect()) == sorted(t or "" for t in texts)
    back = bytepairs.decode(out.select("ids"), bytepairs.ranks_path())
    assert sorted(r.decoded for r in back.collect()) == sorted(t or "" for t in texts)
    assert bytepairs.encode(df.limit(0), bytepairs.ranks_path(), ["n_tokens"]).collect() == []


def test_decoding_of_other_ids(spark, ranks):
    lone = ranks.ids[b"\xc3"]
    df = spark.createDataFrame([([lone],), (None,), ([],)], "ids array<int>")
    assert sorted(r.decoded for r in bytepairs.decode(df, bytepairs.ranks_path()).collect()) == ["", "", "�"]
    with pytest.raises(ValueError, match="vocabulary"):
        ranks.decode(np.array([10**6]))


def test_rank_file_without_a_byte():
    with pytest.raises(ValueError, match="single byte"):
        bytepairs.Ranks(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(255)))


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = library.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
