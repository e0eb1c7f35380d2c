"""Projections that let unlisted columns of an open schema pass through."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame


def replace_columns(df: DataFrame, drop: Iterable[str], add: Mapping[str, Column]) -> DataFrame:
    """Every column except ``drop`` as it is, then the columns of ``add`` in their order.

    The expressions of ``add`` see the columns being dropped, so one may share a name
    with a dropped column and be computed from it.
    """
    dropped = set(drop)
    kept = [df[c] for c in df.columns if c not in dropped]
    return df.select(*kept, *[expr.alias(name) for name, expr in add.items()])
