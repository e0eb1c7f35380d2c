"""Table-level checks; each returns the failing values with their row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.filter("n_rows > 1")


def missing(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a value per column, for all ``columns`` in one pass: (column_name, failures)."""
    once = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return once.unpivot([], list(columns), "column_name", "failures")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values absent from the parent.

    Both sides are reduced to one row per distinct value before they are shuffled, however
    many rows share it.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    return values.join(known, F.col(column) == F.col("_known"), "left_anti")


def unaccepted(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the list; like any comparison, NULL is not judged."""
    counts = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.filter(~F.col(column).isin(*accepted))
