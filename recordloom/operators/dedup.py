"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize_measured
from .joins import BROADCAST_BYTES, ROWS_PER_TASK, sized_join


def _sortable(value: Column, kind: T.DataType) -> Column:
    """The value in a form that can be sorted: equal values, however a map orders its entries, stay equal."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value), lambda e: F.struct(_sortable(e.key, kind.keyType), _sortable(e.value, kind.valueType))
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _sortable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_sortable(value.getField(f.name), f.dataType) for f in kind.fields]))
    return F.to_json(value) if isinstance(kind, T.VariantType) else value


def _needs_form(kind: T.DataType) -> bool:
    text = kind.simpleString()
    return "map<" in text or "variant" in text


def _comparable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [_sortable(F.col(c), kinds[c]) if c in kinds and _needs_form(kinds[c]) else F.col(c) for c in names]


def keep_latest(
    df: DataFrame, key: str, latest: Sequence[Column], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``key``: first by ``latest``, then by ``tiebreak`` ascending (default: all other columns).

    A total order makes the result the same on every run and retry. NULL keys form
    one group. The ``rn = 1`` filter lets Spark limit every group before the shuffle,
    so a key that holds a third of all rows sends at most one row per map task.
    """
    names = [c for c in df.columns if c != key] if tiebreak is None else tiebreak
    order = [*latest, *[c.asc_nulls_last() for c in _comparable(df, names)]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def keep_latest_wide(
    df: DataFrame,
    key: str,
    latest: Sequence[Column],
    tiebreak: Sequence[str],
    budget: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """What ``keep_latest`` keeps, for rows so wide that they should not be sorted.

    Only key, order and a digest of the row are ranked. The digests of the winners are written, and one semi join
    brings the rows, which are hashed but never sorted. Rows that are equal in the order and in ``tiebreak`` are told apart by
    digest. Reads ``df`` twice, so it must give the same rows each time.
    """
    values = _comparable(df, df.columns)
    digested = df.withColumns({"_d1": F.xxhash64(*values), "_d2": F.xxhash64(F.lit("second"), *values)})
    order = [*latest, *[c.asc_nulls_last() for c in _comparable(df, tiebreak)], F.col("_d1"), F.col("_d2")]
    ranked = digested.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1")
    winners, size = materialize_measured(ranked.select(F.col("_d1").alias("_w1"), F.col("_d2").alias("_w2")), "winners")
    on = [(F.col("_d1"), F.col("_w1")), (F.col("_d2"), F.col("_w2"))]
    kept = sized_join(digested, winners, on, "left_semi", df.columns[:1], size, budget, rows_per_task, strategy="shuffle_hash")
    # Rows that repeat in full share a digest; grouping by all columns needs no sort, but has no equality of maps.
    whole = all("map<" not in kind and "variant" not in kind for _, kind in df.dtypes)
    return (kept.distinct() if whole else kept.dropDuplicates(["_d1", "_d2"])).drop("_d1", "_d2")
