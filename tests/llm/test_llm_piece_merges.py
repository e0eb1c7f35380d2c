"""Merges by number and what a worker remembers of them, against the library."""

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from recordloom.llm import pieces

WORDS = ["the", "andanatorea", "  ", "       ", "lyly", "ß", "…", "\n", "é", "漢🙂", "\0", "12.34", "x", " of", "queborr", "▁", "aaaa"]


def blob(scores=None):
    with open(pieces.model_path(), "rb") as f:
        proto = pb.ModelProto.FromString(f.read())
    for i, p in enumerate(proto.pieces):
        p.score = scores(i, p) if scores and p.type == pieces.NORMAL else p.score
    return proto.SerializeToString()


def texts(seed, n=600):
    rng = random.Random(seed)
    return ["", *["".join(rng.choice(WORDS) for _ in range(rng.randint(1, 12))) for _ in range(n)]]


@pytest.fixture(scope="module")
def plain():
    return blob()


def equal(model, library, text):
    ids, lengths, source, decoded = model.encode(text)
    ids = np.frombuffer(ids, "<u4").tolist()
    assert ids == library.encode(text) and decoded == library.decode(ids), text
    told = library.encode(text, return_type="proto").pieces
    bounds = source[np.cumsum(np.append(0, np.frombuffer(lengths, "<u4")))].tolist()
    assert [*zip(bounds, bounds[1:])] == [(p.begin, p.end) for p in told], text


def test_a_stretch_is_merged_once_in_a_worker(plain, monkeypatch):
    """Also across tasks, and without a look at strings: what took two thirds of the time."""
    model = pieces._held(plain)
    assert pieces._held(bytes(bytearray(plain))) is model
    made = []
    monkeypatch.setattr(model.cache, "make", lambda s, make=model.cache.make: made.append(s) or make(s))
    monkeypatch.setattr(model, "merge", None)
    words = [f"unseen{a}stretch{b}" for a in "abcdefgh" for b in "ijklmnop"]
    for _ in range(3):
        for w in words:
            model.encode(w)
    assert sorted(made) == sorted("▁" + w for w in words)
    assert {type(v) for v in model.cache.values()} == {bytes}


@pytest.mark.parametrize("scores", [None, lambda i, p: -(i // 400), lambda i, p: 0.0, lambda i, p: float(i % 7)])
@pytest.mark.parametrize("short", [0, 64])
def test_equal_scores_and_characters_of_no_piece(scores, short, monkeypatch):
    """By numbers and by strings; of equal scores the leftmost counts, whatever the piece."""
    monkeypatch.setattr(pieces, "SHORT", short)
    model, library = pieces.Model(blob(scores)), sentencepiece.SentencePieceProcessor(model_proto=blob(scores))
    assert len(model.tied) > 10
    for text in texts(1):
        equal(model, library, text)


def test_cache_generations(plain, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 3)
    model, library = pieces.Model(plain), sentencepiece.SentencePieceProcessor(model_proto=plain)
    for text in texts(2):
        equal(model, library, text)
        assert len(model.cache) <= 3 and len(model.cache.older) <= 3


def test_bytes_parted_by_an_id_of_nothing(plain):
    model, library = pieces.Model(plain), sentencepiece.SentencePieceProcessor(model_proto=plain)
    euro = [model.byte_ids[b] for b in "€".encode()]
    for ids in ([1, *euro, 2], [euro[0], 1, *euro[1:]], euro[:2], [*euro, *euro[1:]], []):
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("add", [["n_tokens", "ids"], ["spans_sha256"], ["ends", "decoded_sha256"], ["starts", "ids_sha256"], []])
def test_only_what_is_asked_for(spark, plain, add):
    df = spark.createDataFrame([(i, t or None) for i, t in enumerate(texts(3, 40))], "doc_id int, text string").repartition(3)
    every = {r.doc_id: r for r in pieces.encode(df, pieces.model_path(), list(pieces.ADDED)).collect()}
    got = pieces.encode(df, pieces.model_path(), add).collect()
    assert len(got) == len(every) and all(r[c] == every[r.doc_id][c] for r in got for c in ["text", *add])
    library = sentencepiece.SentencePieceProcessor(model_proto=plain)
    assert all(r.ids == [1, *library.encode(r.text or ""), 2] for r in every.values())
