"""Star lookups: left joins from a feed to a dimension that keep the grain of the feed.

Three different null rules stand side by side and must not be merged: the unknown
member, NULL as blank, and strict equality. A key is never computed from the feed
directly, because a value without a member must give a NULL key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import hour_of
from ..functions.cleaning import known_borough, known_zip, trim_all
from ..sources.scratch import materialize
from .joins import BROADCAST_BYTES, ROWS_PER_TASK, measure, sized_join

Match = tuple[Column, Column]


@dataclass(frozen=True)
class Lookup:
    """A dimension, the key to take from it and how its members are matched.

    ``on`` pairs an expression over the feed with one over the dimension, whose
    columns are given by ``member``.
    """

    dim: DataFrame
    key: str
    on: tuple[Match, ...]


def member(name: str) -> Column:
    """A column of the dimension inside a match; prefixed to stay apart from the feed's columns."""
    return F.col(f"_dim_{name}")


def strict(feed: Column, name: str) -> Match:
    """Plain equality: NULL never matches."""
    return feed, member(name)


def null_as_blank(feed: Column, name: str) -> Match:
    """NULL and the empty text match each other; with both as members a row matches twice."""
    return F.coalesce(feed, F.lit("")), F.coalesce(member(name), F.lit(""))


def trimmed_or_default(feed: Column, name: str, default: str) -> Match:
    """Trimmed text; NULL looks up the default member, which matches only if it exists."""
    return F.coalesce(trim_all(feed.cast("string")), F.lit(default)), trim_all(member(name).cast("string"))


def on_day(feed: Column, name: str = "full_date") -> Match:
    return feed.cast("date"), member(name)


def on_hour(feed: Column, name: str = "hour") -> Match:
    return hour_of(feed), member(name)


def unknown_region(zip_code: Column, borough: Column) -> tuple[Match, Match]:
    """Code and borough, a missing code meeting the unknown member."""
    return (known_zip(zip_code), member("zip_code")), (known_borough(borough, False), member("borough"))


def _shared_budget(sizes: Sequence[int], budget: int) -> list[int]:
    """The sizes, those beyond what the smaller ones leave of the budget raised above it."""
    charged, taken = list(sizes), 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        taken += sizes[i]
        if taken > budget:
            charged[i] = max(sizes[i], budget + 1)
    return charged


_TEXTUAL = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.BooleanType)


def _by_text(feed: DataFrame, lookup: Lookup, dim: DataFrame) -> bool:
    """Whether equal parts have equal texts, on both sides, and the key can be had back from its text."""
    asked = feed.select(*[on[0].alias(f"p{i}") for i, on in enumerate(lookup.on)]).schema
    held = dim.select(*[on[1].alias(f"p{i}") for i, on in enumerate(lookup.on)], member(lookup.key).alias("key")).schema
    alike = lambda a, b: a == b or isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)
    same = all(alike(a.dataType, b.dataType) for a, b in zip(asked, held))
    return same and all(isinstance(f.dataType, _TEXTUAL) for f in held)


def _look_up_together(feed: DataFrame, lookups: Sequence[Lookup], dims: Sequence[DataFrame], budget: int, rows_per_task: int) -> DataFrame:
    """Append the keys of several large dimensions, shuffling the feed once however many they are.

    The feed is written with a number for every row. Only numbers and looked-up values go to the members, all
    dimensions in one join with hot values split; the answers are gathered by number and meet the feed in one more.
    """
    fed = materialize(feed.withColumn("_row", F.monotonically_increasing_id()), "numbered_feed")

    def parts(lookup: Lookup, side: int) -> Column:
        return F.array(*[on[side].cast("string") for on in lookup.on])

    asked = [F.struct(F.lit(i).alias("_dim"), parts(lk, 0).alias("_value")) for i, lk in enumerate(lookups)]
    asked = fed.select("_row", F.inline(F.array(*asked))).filter(~F.exists("_value", lambda part: part.isNull()))
    members = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(i).alias("_of"), parts(lk, 1).alias("_member"), member(lk.key).cast("string").alias("_key"))
            for i, (lk, dim) in enumerate(zip(lookups, dims))
        ],
    )
    on = [(F.col("_dim"), F.col("_of")), (F.col("_value"), F.col("_member"))]
    found = sized_join(asked, members, on, "inner", ["_row"], budget + 1, budget, rows_per_task)
    answer = [F.collect_list(F.when(F.col("_dim") == i, F.struct("_key"))).alias(f"_answer{i}") for i in range(len(lookups))]
    answers = materialize(found.groupBy("_row").agg(*answer), "answers")
    joined = fed.join(answers.hint("merge"), "_row", "left")
    for i, (lk, dim) in enumerate(zip(lookups, dims)):
        kind = dim.schema[f"_dim_{lk.key}"].dataType
        # A value with several members gives as many rows, like a join.
        joined = joined.withColumn("_found", F.explode_outer(f"_answer{i}")).withColumn(lk.key, F.col("_found._key").cast(kind))
    return joined.select(*feed.columns, *[lk.key for lk in lookups])


def look_up(
    feed: DataFrame,
    lookups: Sequence[Lookup],
    spread: Sequence[str] | None = None,
    budget: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Append the key of every lookup to ``feed``.

    All dimensions are measured in one job. The smallest that fit the budget together are broadcast in
    the same stage as the scan of the feed, so a star of small dimensions shuffles nothing. One beyond it is joined by a
    shuffle of the feed, and several together by one as well.
    """
    given = feed
    narrow = [lk.dim.select(*[F.col(c).alias(f"_dim_{c}") for c in lk.dim.columns]) for lk in lookups]
    sizes = _shared_budget(measure(*narrow), budget) if lookups else []
    apart = [i for i, size in enumerate(sizes) if size > budget and _by_text(given, lookups[i], narrow[i])]
    apart = apart if len(apart) > 1 else []
    for i, (lk, dim, size) in enumerate(zip(lookups, narrow, sizes)):
        if i not in apart:
            joined = sized_join(feed, dim, lk.on, "left", spread, size, budget, rows_per_task, given)
            feed = joined.select(*feed.columns, member(lk.key).alias(lk.key))
    if apart:
        feed = _look_up_together(feed, [lookups[i] for i in apart], [narrow[i] for i in apart], budget, rows_per_task)
    return feed.select(*given.columns, *[lk.key for lk in lookups])
