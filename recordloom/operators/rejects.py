"""Values that cannot be read, listed beside the rows that have NULL in their place."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

REJECTS = "_rejects"


def rejects(key: Column, read: Mapping[str, tuple[Column, Column, str]]) -> Column:
    """What a row's tolerant casts gave up: an array of (key, column, text, reason).

    ``read`` has for each column what was given, what was read and the reason to state. A NULL
    was not given, so it is no reject.
    """
    entries = [
        F.when(
            given.isNotNull() & got.isNull(),
            F.struct(key.cast("string").alias("key"), F.lit(name).alias("column"), given.cast("string").alias("text"), F.lit(reason).alias("reason")),
        )
        for name, (given, got, reason) in read.items()
    ]
    return F.array_compact(F.array(*entries))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows without ``REJECTS``, and the rejects (key, column, text, reason), once each.

    The rows are written, so they are cleaned in one pass for both.
    """
    written = materialize(df, "with_rejects")
    return written.drop(REJECTS), written.select(F.inline(REJECTS)).distinct()
