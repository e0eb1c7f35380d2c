"""Joins whose strategy follows from the measured size of the right side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import byte_count, materialize, materialize_measured

# Right sides are broadcast up to this many bytes; every executor holds one copy of them.
BROADCAST_BYTES = 64 << 20

# Beyond it, a left key with more rows than this is split over several tasks.
ROWS_PER_TASK = 5_000_000

# Left rows with a NULL key match nothing; they are spread over this many salts.
NULL_SALTS = 1 << 20


def measure(*frames: DataFrame) -> list[int]:
    """The size of each frame's rows in memory, counted over all rows in one job.

    Meant for written tables, where it costs a scan. Returns one number per frame.
    """
    sums = [df.agg(byte_count(df).alias("n")).withColumn("i", F.lit(i)) for i, df in enumerate(frames)]
    return [row.n for row in sorted(reduce(DataFrame.union, sums).collect(), key=lambda row: row.i)]


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _hot_keys(left: DataFrame, keys: list[str], rows_per_task: int) -> tuple[DataFrame, int]:
    """Keys with more rows than one task should get, into how many parts to split each, and the list's size in bytes.

    At most rows(left) / rows_per_task keys qualify, and all of them are split.
    """
    counts = left.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot, size = materialize_measured(counts.filter(F.col("_rows") > rows_per_task), "hot_keys")
    return hot.select(*keys, F.ceil(F.col("_rows") / rows_per_task).cast("bigint").alias("_splits")), size


def sized_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[Column, Column]],
    how: str = "left",
    spread: Sequence[str] | None = None,
    size: int | None = None,
    budget: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    count_keys_in: DataFrame | None = None,
    strategy: str = "merge",
) -> DataFrame:
    """Equi-join on pairs of (left expression, right expression), without shuffling ``left`` if it can.

    A right side within ``budget`` bytes is broadcast. A larger one is joined by a
    shuffle in which hot left keys are split over salts, each split meeting its own
    copy of the matching right rows, and rows with a NULL key are spread out. No row
    is dropped either way. ``spread`` names left columns that vary within a hot key
    (default: all). ``count_keys_in`` may give a cheaper frame with the left keys to look
    for hot ones in, ``strategy`` a join hint for the shuffle. ``left`` and ``right`` must have no column name in common.

    The shuffle is always asked for by a hint: Spark judges a table by its file, a small part of what it takes in memory,
    and would broadcast what was just found too large.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    left_keys = {k: expr for k, (expr, _) in zip(keys, on)}
    keyed_left = left.withColumns(left_keys)
    keyed_right = right.withColumns({f"{k}r": r for k, (_, r) in zip(keys, on)})
    match = [F.col(k) == F.col(f"{k}r") for k in keys]
    helpers = [*keys, *[f"{k}r" for k in keys], "_splits", "_salt", "_saltr"]

    if (measure(right)[0] if size is None else size) <= budget:
        return keyed_left.join(F.broadcast(keyed_right), reduce(and_, match), how).drop(*helpers)

    counted = left if count_keys_in is None else count_keys_in
    hot, hot_size = _hot_keys(counted.withColumns(left_keys), keys, rows_per_task)
    # A list beyond the budget is joined by a shuffle.
    listed = F.broadcast if hot_size <= budget else (lambda df: df.hint("merge"))
    row_hash = F.xxhash64(*(spread or _hashable(left)))
    splits = F.coalesce(F.col("_splits"), F.lit(1).cast("bigint"))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.pmod(row_hash, F.when(no_key, F.lit(NULL_SALTS).cast("bigint")).otherwise(splits))
    salted_left = keyed_left.join(listed(hot), keys, "left").withColumn("_salt", salt)
    hot_right = hot.withColumnsRenamed({k: f"{k}r" for k in keys})
    salted_right = keyed_right.join(listed(hot_right), [f"{k}r" for k in keys], "left").withColumn(
        "_saltr", F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1))
    )
    salted_right = salted_right.drop("_splits").hint(strategy)
    condition = reduce(and_, [*match, F.col("_salt") == F.col("_saltr")])
    return salted_left.join(salted_right, condition, how).drop(*helpers).select(
        *left.columns, *([] if how in ("left_anti", "left_semi") else right.columns)
    )
