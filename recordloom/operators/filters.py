"""Row filters, written so that they reach the parquet scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_scope(
    df: DataFrame,
    required: tuple[str, ...] = (),
    since: tuple[str, dt.date] | None = None,
    equal: dict[str, str] | None = None,
) -> DataFrame:
    """Rows with all ``required`` columns, on or after a day, and with exact category values."""
    tests: list[Column] = [F.col(c).isNotNull() for c in required]
    if since is not None:
        column, day = since
        tests.append(F.col(column).cast("date") >= F.lit(day))
    tests += [F.col(c) == value for c, value in (equal or {}).items()]
    return df.filter(reduce(and_, tests)) if tests else df


def needs_region(zip_code: Column, borough: Column, longitude: Column, latitude: Column) -> Column:
    """True when a region field is missing and the coordinates can supply it."""
    return (zip_code.isNull() | borough.isNull()) & latitude.isNotNull() & longitude.isNotNull()
