"""Staging: one clean row per natural key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import (
    CITYWIDE,
    clean_borough,
    clean_zip,
    date_and_clock,
    normalize_token,
    to_numeric,
    to_timestamp,
    zero_to_null,
)
from ..operators.dedup import keep_latest
from ..operators.filters import in_scope
from ..operators.projection import replace_columns
from ..operators.regions import CELL, enrich_regions
from ..operators.rejects import REJECTS, rejects

# The scope of the request feed.
REQUEST_CATEGORY = "Illegal Parking"
REQUESTS_SINCE = dt.date(2020, 1, 1)


def stage_requests(
    raw: DataFrame,
    category: str = REQUEST_CATEGORY,
    since: dt.date = REQUESTS_SINCE,
    tiebreak: list[str] | None = None,
    strict: bool = True,
    keep_rejects: bool = False,
) -> DataFrame:
    """Requests in scope, the latest row per key, cleaned. Filters come first: the latest qualifying row wins.

    What ``strict=False`` turns into NULL is listed in a further column with ``keep_rejects`` (see ``split_rejects``).
    """
    scoped = in_scope(raw, ("unique_key", "created_date"), ("created_date", since), {"complaint_type": category})
    latest = keep_latest(scoped, "unique_key", [F.col("created_date").desc_nulls_last()], tiebreak)

    def text(name: str):
        return F.col(name).cast("string")

    cleaned = {
        "complaint_id": text("unique_key"),
        "created_date": to_timestamp(F.col("created_date"), strict),
        "closed_date": to_timestamp(F.col("closed_date"), strict),
        "agency": text("agency"),
        "agency_name": text("agency_name"),
        "complaint_type": text("complaint_type"),
        "descriptor": text("descriptor"),
        "location_type": text("location_type"),
        "status": normalize_token(F.col("status")),
        "incident_zip": clean_zip(F.col("incident_zip")),
        "borough": clean_borough(F.col("borough"), CITYWIDE),
        "incident_address": text("incident_address"),
        "street_name": text("street_name"),
        "cross_street_1": text("cross_street_1"),
        "cross_street_2": text("cross_street_2"),
        "latitude": to_numeric(F.col("latitude"), strict),
        "longitude": to_numeric(F.col("longitude"), strict),
        "method_of_submission": text("open_data_channel_type"),
        "_stg_loaded_at": F.current_timestamp(),
    }
    renamed = {"unique_key", "open_data_channel_type"}
    if keep_rejects:
        times = {c: (F.col(c), to_timestamp(F.col(c), False), "no timestamp") for c in ("created_date", "closed_date")}
        numbers = {c: (F.col(c), to_numeric(F.col(c), False), "no number") for c in ("latitude", "longitude")}
        cleaned[REJECTS] = rejects(F.col("unique_key"), times | numbers)
    return replace_columns(latest, renamed | set(cleaned), cleaned)


def _clean_crash_fields(strict: bool) -> dict:
    def text(name: str):
        return F.col(name).cast("string")

    return {
        "collision_id": text("collision_id"),
        "crash_time": text("crash_time"),
        "crash_date": date_and_clock(F.col("crash_date"), F.col("crash_time"), strict),
        "zip_code": clean_zip(F.col("zip_code")),
        "borough": clean_borough(F.col("borough")),
        "latitude": zero_to_null(F.col("latitude"), strict),
        "longitude": zero_to_null(F.col("longitude"), strict),
        "on_street_name": text("on_street_name"),
        "off_street_name": text("off_street_name"),
        "cross_street_name": text("cross_street_name"),
    }


def clean_crashes(raw: DataFrame, tiebreak: list[str] | None = None, strict: bool = True, keep_rejects: bool = False) -> DataFrame:
    """The latest row per collision, cleaned; region fields that cannot be cleaned stay NULL."""
    when = date_and_clock(F.col("crash_date"), F.col("crash_time"), strict)
    order = [F.col("crash_date").desc_nulls_last(), when.desc_nulls_last()]
    latest = keep_latest(raw, "collision_id", order, tiebreak)
    cleaned = _clean_crash_fields(strict) | {"_stg_loaded_at": F.current_timestamp()}
    if keep_rejects:
        numbers = {c: (F.col(c), to_numeric(F.col(c), False), "no number") for c in ("latitude", "longitude")}
        stamp = F.concat(F.col("crash_date").cast("string"), F.lit(" "), F.col("crash_time").cast("string"))
        read = date_and_clock(F.col("crash_date"), F.col("crash_time"), False)
        cleaned[REJECTS] = rejects(F.col("collision_id"), numbers | {"crash_date": (stamp, read, "no day and clock")})
    return replace_columns(latest, cleaned, cleaned)


def crash_places(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Cleaned region fields and coordinates of every raw row; reads four columns and shuffles nothing."""
    cleaned = _clean_crash_fields(strict)
    return raw.select(*[cleaned[c].alias(c) for c in ("zip_code", "borough", "longitude", "latitude")])


def stage_crashes(
    raw: DataFrame,
    seed: DataFrame,
    tiebreak: list[str] | None = None,
    multi: str = "all",
    cell: float = CELL,
    strict: bool = True,
    keep_rejects: bool = False,
) -> DataFrame:
    """Clean collisions whose missing region fields are filled from the polygons of ``seed``.

    The raw feed is read twice: four columns of it for the occupied grid cells, in which superseded rows
    may hold anything, and all of it for the deduplication, which is its only shuffle within the budget.
    """
    return enrich_regions(
        clean_crashes(raw, tiebreak, strict, keep_rejects),
        seed,
        "collision_id",
        places=crash_places(raw, strict=False),
        multi=multi,
        cell=cell,
        strict=strict,
    )
