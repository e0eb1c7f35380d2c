"""Facts: one row per staged record, with the keys of its dimension members and additive measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.lookups import (
    Lookup,
    look_up,
    null_as_blank,
    on_day,
    on_hour,
    strict,
    trimmed_or_default,
    unknown_region,
)

# The members that a missing factor or vehicle looks up.
DEFAULT_FACTOR = "Unspecified"
DEFAULT_VEHICLE = "UNKNOWN"


def _one(name: str) -> Column:
    return F.lit(1).cast("bigint").alias(name)


def request_lookups(dims: Mapping[str, DataFrame]) -> list[Lookup]:
    c = F.col
    return [
        Lookup(dims["date"].select("date_key", "full_date"), "date_key", (on_day(c("created_date")),)),
        Lookup(dims["geography"], "geo_key", unknown_region(c("incident_zip"), c("borough"))),
        Lookup(
            dims["complaint"],
            "complaint_key",
            (
                strict(c("complaint_type"), "complaint_type"),
                null_as_blank(c("descriptor"), "descriptor"),
                null_as_blank(c("location_type"), "location_type"),
            ),
        ),
        Lookup(
            dims["agency"],
            "agency_key",
            (strict(c("agency"), "agency"), null_as_blank(c("agency_name"), "agency_name")),
        ),
        Lookup(dims["channel"], "channel_key", (strict(c("method_of_submission"), "method_of_submission"),)),
        Lookup(dims["status"], "status_key", (strict(c("status"), "status"),)),
    ]


def fact_requests(staged: DataFrame, dims: Mapping[str, DataFrame], **join) -> DataFrame:
    """One row per request (more only where the complaint dimension holds both NULL and blank)."""
    needed = staged.select(
        "complaint_id", "created_date", "incident_zip", "borough", "complaint_type", "descriptor",
        "location_type", "agency", "agency_name", "method_of_submission", "status",
    )
    keyed = look_up(needed, request_lookups(dims), spread=["complaint_id"], **join)
    return keyed.select(
        surrogate_key("complaint_id").alias("fact_illegal_parking_key"),
        "complaint_id", "date_key", "geo_key", "complaint_key", "agency_key", "channel_key", "status_key",
        _one("complaint_count"),
    )


def crash_lookups(dims: Mapping[str, DataFrame]) -> list[Lookup]:
    c = F.col
    return [
        Lookup(dims["date"].select("date_key", "full_date"), "date_key", (on_day(c("crash_date")),)),
        Lookup(dims["geography"], "geo_key", unknown_region(c("zip_code"), c("borough"))),
        Lookup(dims["crash_time"].select("crash_time_key", "hour"), "crash_time_key", (on_hour(c("crash_date")),)),
        Lookup(
            dims["factor"],
            "factor_key",
            (trimmed_or_default(c("contributing_factor_vehicle_1"), "factor_desc", DEFAULT_FACTOR),),
        ),
        Lookup(
            dims["vehicle"],
            "vehicle_type_key",
            (trimmed_or_default(c("vehicle_type_code1"), "vehicle_type_desc", DEFAULT_VEHICLE),),
        ),
    ]


def fact_crashes(staged: DataFrame, dims: Mapping[str, DataFrame], **join) -> DataFrame:
    """One row per staged collision."""
    needed = staged.select(
        "collision_id", "crash_date", "zip_code", "borough", "contributing_factor_vehicle_1",
        "vehicle_type_code1", "number_of_persons_injured", "number_of_persons_killed",
    )
    keyed = look_up(needed, crash_lookups(dims), spread=["collision_id"], **join)
    return keyed.select(
        surrogate_key("collision_id").alias("fact_mvc_key"),
        "collision_id", "date_key", "geo_key", "crash_time_key", "factor_key", "vehicle_type_key",
        _one("crash_count"), "number_of_persons_injured", "number_of_persons_killed",
    )
