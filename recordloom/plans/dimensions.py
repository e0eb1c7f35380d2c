"""Dimensions: distinct members with a hashed key in front."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, hour_of, time_band
from ..functions.cleaning import blank_to_null, known_borough, known_zip, normalize_token
from ..functions.keys import surrogate_key
from ..operators.members import members, union_members, with_key


def days(feed: DataFrame, column: str) -> DataFrame:
    """The distinct days of a timestamp column."""
    return members(feed, ("full_date",), full_date=F.col(column).cast("date"))


def dim_date(*day_sets: DataFrame) -> DataFrame:
    """One row per day seen in any feed, with its calendar attributes."""
    day = F.col("full_date")
    return union_members(*day_sets).select(surrogate_key(day).alias("date_key"), day, *calendar_columns(day))


def request_regions(staged: DataFrame) -> DataFrame:
    return members(staged, borough=known_borough(F.col("borough"), False), zip_code=known_zip(F.col("incident_zip")))


def crash_regions(staged: DataFrame) -> DataFrame:
    return members(staged, borough=known_borough(F.col("borough")), zip_code=known_zip(F.col("zip_code")))


def dim_geography(*region_sets: DataFrame) -> DataFrame:
    """One row per (borough, code) seen in any feed."""
    return with_key(union_members(*region_sets), "geo_key")


def dim_agency(requests: DataFrame) -> DataFrame:
    return with_key(members(requests, agency=F.col("agency"), agency_name=F.col("agency_name")), "agency_key")


def dim_channel(requests: DataFrame) -> DataFrame:
    return with_key(members(requests, method_of_submission=F.col("method_of_submission")), "channel_key")


def dim_complaint(requests: DataFrame) -> DataFrame:
    names = ("complaint_type", "descriptor", "location_type")
    return with_key(members(requests, **{n: F.col(n) for n in names}), "complaint_key")


def dim_status(requests: DataFrame) -> DataFrame:
    return with_key(members(requests, ("status",), status=normalize_token(F.col("status"))), "status_key")


def dim_factor(crashes: DataFrame, column: str = "contributing_factor_vehicle_1") -> DataFrame:
    return with_key(members(crashes, ("factor_desc",), factor_desc=blank_to_null(F.col(column))), "factor_key")


def dim_vehicle(crashes: DataFrame, column: str = "vehicle_type_code1") -> DataFrame:
    found = members(crashes, ("vehicle_type_desc",), vehicle_type_desc=blank_to_null(F.col(column)))
    return with_key(found, "vehicle_type_key")


def dim_crash_time(crashes: DataFrame) -> DataFrame:
    """One row per hour of day with its time band."""
    hours = members(crashes, ("hour",), hour=hour_of(F.col("crash_date")))
    return with_key(hours, "crash_time_key").withColumn("time_band", time_band(F.col("hour")))
