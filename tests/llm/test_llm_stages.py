"""Every stage of the pipeline on odd rows, clashing columns and an empty table."""

from collections import Counter

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, k1 int, score double, hash string"


@pytest.fixture(scope="module")
def docs(spark):
    prose = " ".join(f"word{i} and the other of it" for i in range(40))
    texts = [None, "", " \n\n ", "one", "x" * 100_000, prose, prose, prose + " and more", "first line\nsecond line\n" + prose, "first line\nsecond line\nother words", "a b " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, prose), (None, prose), (None, None), (3, "another")]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", 1, 0.5, "h") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    added = ["n_tokens", "ids", "decoded_sha256"] if name == "pieces" else []
    assert out.columns == [*docs.columns, *added]
    given = Counter((r.doc_id, r.text) for r in docs.collect())
    got = out.collect()
    assert {(r.lang, r.row, r.k1, r.score, r.hash) for r in got} <= {("en", "r", 1, 0.5, "h")}
    if name != "line_dedup":  # which changes texts
        assert not Counter((r.doc_id, r.text) for r in got) - given
    if name == "pieces":
        assert len(got) == docs.count()
    if name == "near_copies":
        kept = Counter((r.doc_id, r.text) for r in got)
        assert max(kept.values()) == 1 and kept[None, None] == kept[0, None] == kept[1, ""] == kept[3, "another"] == 1
        assert sum((t or "").startswith("word0") for _, t in kept) == 1  # the least id of the class
    if name == "line_dedup":
        assert {r.text for r in got if r.doc_id == 0} == {None} and not any(r.text.startswith("first") for r in got if r.doc_id == 9)
        assert all(r.n_chars == len(r.text or "") for r in got)
    if name == "decontaminate":
        assert len(got) == docs.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SF).count() == 0
