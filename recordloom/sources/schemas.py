"""Explicit schemas of the raw feeds and the region seed.

Column names and their order are fixed values: they are the published columns of
the two feeds. Identifiers and postal codes stay text to keep leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _timestamps(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.TimestampType()) for n in names]


def _counts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


REQUESTS = T.StructType(
    _strings("unique_key")
    + _timestamps("created_date", "closed_date")
    + _strings(
        "agency", "agency_name", "complaint_type", "descriptor", "additional_details", "location_type",
        "incident_zip", "incident_address", "street_name", "cross_street_1", "cross_street_2",
        "intersection_street_1", "intersection_street_2", "address_type", "city", "landmark", "status",
        "due_date", "resolution_description", "resolution_action_updated", "community_board",
        "council_district", "bbl", "borough", "x_coordinate_state_plane", "y_coordinate_state_plane",
        "open_data_channel_type", "latitude", "longitude", "location",
    )
)

CRASHES = T.StructType(
    _strings("collision_id")
    + _timestamps("crash_date")
    + _strings(
        "crash_time", "borough", "zip_code", "latitude", "longitude", "location", "on_street_name",
        "cross_street_name", "off_street_name",
    )
    + _counts(
        "number_of_persons_injured", "number_of_persons_killed", "number_of_pedestrians_injured",
        "number_of_pedestrians_killed", "number_of_cyclist_injured", "number_of_cyclist_killed",
        "number_of_motorist_injured", "number_of_motorist_killed",
    )
    + _strings(
        "contributing_factor_vehicle_1", "contributing_factor_vehicle_2", "contributing_factor_vehicle_3",
        "contributing_factor_vehicle_4", "contributing_factor_vehicle_5", "vehicle_type_code1",
        "vehicle_type_code2", "vehicle_type_code_3", "vehicle_type_code_4", "vehicle_type_code_5",
    )
)

REGION_SEED = T.StructType(_strings("zip_code", "borough", "geom_wkt"))
