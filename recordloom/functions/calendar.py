"""Calendar attributes, holiday rules and time bands."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

SUNDAY, MONDAY, THURSDAY, SATURDAY = 1, 2, 5, 7

# Holidays on a set day, as (month, day).
SET_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))

# Holidays on a weekday, as (month, weekday, first and last possible day of month).
WEEKDAY_HOLIDAYS = (
    (1, MONDAY, 15, 21),
    (2, MONDAY, 15, 21),
    (5, MONDAY, 25, 31),
    (9, MONDAY, 1, 7),
    (10, MONDAY, 8, 14),
    (11, THURSDAY, 22, 28),
)

# Time bands, as (first hour, last hour, label).
TIME_BANDS = ((0, 5, "Night"), (6, 11, "Morning"), (12, 17, "Afternoon"), (18, 23, "Evening"))
NO_BAND = "Unknown"


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(SUNDAY, SATURDAY)


def is_holiday(day: Column) -> Column:
    """Federal holidays on their nominal day; never NULL."""
    month, number, weekday = F.month(day), F.dayofmonth(day), F.dayofweek(day)
    on_set_day = [(month == m) & (number == d) for m, d in SET_HOLIDAYS]
    on_weekday = [(month == m) & (weekday == w) & number.between(lo, hi) for m, w, lo, hi in WEEKDAY_HOLIDAYS]
    return F.coalesce(reduce(or_, on_set_day + on_weekday), F.lit(False))


def calendar_columns(day: Column) -> list[Column]:
    """Year to holiday flag, in the column order of the date dimension."""
    return [
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        is_holiday(day).alias("is_holiday"),
    ]


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def time_band(hour: Column) -> Column:
    return F.coalesce(*[F.when(hour.between(lo, hi), F.lit(label)) for lo, hi, label in TIME_BANDS], F.lit(NO_BAND))
