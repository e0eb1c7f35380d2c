"""What the operators of this subpackage share: row identity, words, and grouping that survives hot keys."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Two hashes of the whole row: 128 bits, never NULL. Rows repeated in full share them, and share their fate.
ROW = ["k1", "k2"]

# A group is bundled into lists of about this many rows, however large it is.
BUNDLE_ROWS = 2_000

WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text, k1, k2), so other columns can have any name; a NULL text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.col(id_col), text).alias("k1"),
        F.xxhash64(text, F.col(id_col)).alias("k2"),
    )


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same identity beside the whole row as one struct, to bring every input column through a join."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(F.col(id_col), text).alias("k1"),
        F.xxhash64(text, F.col(id_col)).alias("k2"),
    )


def words(text: Column) -> Column:
    """A-Z in lower case, then runs of digits, a-z and everything beyond ASCII. NULL has none.

    ``lower`` would also change letters beyond ASCII, so only pure ASCII takes that faster way.
    """
    low = F.when(
        text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    ).otherwise(F.lower(text))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), WORD_BREAKS), "")


def bundles(rows: DataFrame, keys: list[str], values: list[str], *, size: Column | None = None, **totals: Column) -> DataFrame:
    """Groups as several lists of rows each: ``keys``, ``rows`` (array of structs) and the ``totals`` of the list.

    A key that holds a third of all rows becomes many short lists, which may then meet a
    per-key table without one task getting them all. ``size``, where known, is the number
    of rows of the key; otherwise all keys are spread as if they were the largest possible.
    """
    if size is None:
        lists = F.lit(max(1, -(-rows.count() // BUNDLE_ROWS)))
    else:
        lists = F.ceil(size / F.lit(BUNDLE_ROWS))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in values]), lists.cast("bigint"))
    return (
        rows.withColumn("_part", part)
        .groupBy(*keys, "_part")
        .agg(F.collect_list(F.struct(*values)).alias("rows"), *[e.alias(n) for n, e in totals.items()])
    )


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])
