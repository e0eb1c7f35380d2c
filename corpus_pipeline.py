"""A training corpus from raw documents: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``.

For all stages: a NULL text counts as empty and stays NULL; ids may be NULL or repeat, rows are told apart by id and text;
further columns of any name pass through as they are; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontaminate as leaks
from recordloom.llm import jaccard, lines, pieces, quality
from recordloom.llm.common import read
from recordloom.sources.scratch import delete_path, scratch_path, temporary_tables


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labels of those not held out, rates at 0.7 or more.

    Empty texts are rated like others; of labels that repeat for an id the largest counts.
    """
    return quality.keep_good(docs, quality.learn(docs, read(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of two lines or more that stand earlier in the corpus; documents of which nothing is left go.

    The first of several is the one of the least id, NULL first; rows repeated in full share their fate. Empty texts, and texts of one
    line, stay as they are.
    """
    cut = lines.drop_repeated_passages(docs, drop_emptied=True)
    length = F.when(F.col("lines_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cut.withColumns({"n_chars": length} if "n_chars" in docs.columns else {}).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class of near copies; of rows repeated in full one, and all texts without words."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; those without words hold none."""
    return leaks.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the token ids with begin and end, their number, and a digest of the text they decode to; columns so named are replaced."""
    return pieces.encode(docs, pieces.model_path(), ["n_tokens", "ids", "decoded_sha256"])


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_copies", one_of_near_copies),
    ("decontaminate", without_benchmark),
    ("pieces", encoded),
]

# A fitted classifier, chosen paths and piece merges are beyond SQL; tests/llm compares with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage writes on the way goes with its end, its documents once the next stage has them."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage_{name}")
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
