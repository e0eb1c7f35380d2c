"""One query per operator, over the test tables or feeds derived from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import cleaning as clean
from recordloom.functions.geometry import wkt_edges
from recordloom.functions.keys import surrogate_key
from recordloom.operators import lookups as lk
from recordloom.operators import quality, regions as rg
from recordloom.operators.dedup import keep_latest, keep_latest_wide
from recordloom.operators.filters import in_scope, needs_region
from recordloom.operators.members import union_members
from recordloom.operators.projection import replace_columns
from recordloom.plans import dimensions as dim
from recordloom.plans.checks import run_checks
from recordloom.plans.facts import crash_lookups, fact_crashes, fact_requests, request_lookups
from recordloom.plans.staging import clean_crashes, stage_crashes, stage_requests
from recordloom.plans.star import (
    build_star,
    crash_dimensions,
    request_dimensions,
    save_all,
    shared_dimensions,
    to_folder,
)
from recordloom.sources import materialize, read_seed, scratch_path, write_path

from . import feeds
from .feeds import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash with an import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


col = F.col
TIES = ["source_row"]


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return stage_requests(feeds.requests(spark, sf), tiebreak=TIES).drop("_stg_loaded_at")


def _clean_crashes(spark: SparkSession, sf: str) -> DataFrame:
    return clean_crashes(feeds.crashes(spark, sf), tiebreak=TIES).drop("_stg_loaded_at")


def _crashes(spark: SparkSession, sf: str) -> DataFrame:
    raw, seed = feeds.crashes(spark, sf), feeds.regions(spark, sf)
    return stage_crashes(raw, seed, tiebreak=TIES).drop("_stg_loaded_at")


def _saved(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return save_all(frames, lambda name, df: materialize(df, name))


# ---- sources and sinks ------------------------------------------------------------------------


@query
def seed_scan_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "seed")
    # Columns in another order than the schema's: they are found by name.
    feeds.regions(spark, sf).select("geom_wkt", "borough", "zip_code").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return read_seed(spark, path)


@query
def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "orders")
    write_path(orders.filter(col("o_orderstatus") == "F"), path)
    return write_path(orders, path)


# ---- projections and cleaning -----------------------------------------------------------------


@query
def star_except_clean(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = {
        "complaint_id": col("unique_key").cast("string"),
        "status": clean.normalize_token(col("status")),
        "incident_zip": clean.clean_zip(col("incident_zip")),
        "borough": clean.clean_borough(col("borough"), clean.CITYWIDE),
    }
    raw = feeds.requests(spark, sf)
    return replace_columns(raw, ["unique_key", "status", "incident_zip", "borough"], cleaned)


@query
def rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.requests(spark, sf).select(
        col("source_row"),
        col("unique_key").cast("string").alias("complaint_id"),
        col("open_data_channel_type").cast("string").alias("method_of_submission"),
    )


@query
def cast_timestamp_date(spark: SparkSession, sf: str) -> DataFrame:
    stamp = clean.to_timestamp(col("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", stamp.alias("ordered_at"), stamp.cast("date").alias("ordered_on"))


@query
def cast_decimal(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber",
        clean.to_numeric(col("l_extendedprice")).alias("price"),
        clean.to_numeric(col("l_discount")).alias("discount"),
    )


@query
def clean_zip(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.requests(spark, sf).select("source_row", clean.clean_zip(col("incident_zip")).alias("incident_zip"))


@query
def clean_region(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.requests(spark, sf).select(
        "source_row",
        clean.clean_borough(col("borough"), clean.CITYWIDE).alias("borough"),
        clean.clean_borough(col("borough")).alias("borough_or_null"),
    )


@query
def null_zero(spark: SparkSession, sf: str) -> DataFrame:
    zeroed = [clean.zero_to_null(col(c)).alias(c) for c in ("latitude", "longitude")]
    return feeds.crashes(spark, sf).select("source_row", *zeroed)


@query
def compose_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    when = clean.date_and_clock(col("crash_date"), col("crash_time"))
    return feeds.crashes(spark, sf).select("source_row", when.alias("crash_date"))


@query
def surrogate_key_(spark: SparkSession, sf: str) -> DataFrame:
    key = surrogate_key("agency", "descriptor", col("closed_date").cast("date"))
    return feeds.requests(spark, sf).select("source_row", key.alias("key"))


# ---- filters, deduplication, members ----------------------------------------------------------


@query
def filter_scope(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    scope = in_scope(orders, ("o_custkey", "o_orderdate"), ("o_orderdate", dt.date(1997, 1, 1)), {"o_orderstatus": "F"})
    return scope.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")


@query
def enrich_gate(spark: SparkSession, sf: str) -> DataFrame:
    raw = feeds.crashes(spark, sf)
    zip_code, borough = clean.clean_zip(col("zip_code")), clean.clean_borough(col("borough"))
    longitude, latitude = clean.zero_to_null(col("longitude")), clean.zero_to_null(col("latitude"))
    return raw.filter(needs_region(zip_code, borough, longitude, latitude)).select("source_row")


@query
def dedup_keep_latest(spark: SparkSession, sf: str) -> DataFrame:
    return keep_latest(table(spark, sf, "orders"), "o_custkey", [col("o_orderdate").desc_nulls_last()], ["o_orderkey"])


@query
def dedup_keep_latest_wide(spark: SparkSession, sf: str) -> DataFrame:
    """By ranking keys and digests, beyond the broadcast budget."""
    orders = table(spark, sf, "orders")
    return keep_latest_wide(orders, "o_custkey", [col("o_orderdate").desc_nulls_last()], ["o_orderkey"], budget=0)


@query
def union_distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    ordered = dim.days(table(spark, sf, "orders"), "o_orderdate")
    return union_members(ordered, dim.days(table(spark, sf, "lineitem"), "l_shipdate"))


# ---- staging and dimensions -------------------------------------------------------------------


@query
def stg_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf)


@query
def stg_crashes(spark: SparkSession, sf: str) -> DataFrame:
    return _crashes(spark, sf)


@query
def stg_crashes_odd(spark: SparkSession, sf: str) -> DataFrame:
    raw, seed = feeds.crashes_odd(spark, sf), feeds.regions(spark, sf)
    return stage_crashes(raw, seed, tiebreak=TIES).drop("_stg_loaded_at")


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    requests, crashes = _requests(spark, sf), _clean_crashes(spark, sf)
    return dim.dim_date(dim.days(requests, "created_date"), dim.days(crashes, "crash_date"))


@query
def dim_region(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_geography(dim.request_regions(_requests(spark, sf)), dim.crash_regions(_crashes(spark, sf)))


@query
def dim_agency(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_agency(_requests(spark, sf))


@query
def dim_channel(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_channel(_requests(spark, sf))


@query
def dim_complaint(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_complaint(_requests(spark, sf))


@query
def dim_status(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_status(_requests(spark, sf))


@query
def dim_factor(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_factor(_clean_crashes(spark, sf))


@query
def dim_vehicle(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_vehicle(_clean_crashes(spark, sf))


@query
def dim_time_band(spark: SparkSession, sf: str) -> DataFrame:
    return dim.dim_crash_time(_clean_crashes(spark, sf))


# ---- lookups and facts ------------------------------------------------------------------------


@query
def lookup_date(spark: SparkSession, sf: str) -> DataFrame:
    days = materialize(dim.dim_date(dim.days(table(spark, sf, "lineitem"), "l_shipdate")), "days")
    lookup = lk.Lookup(days.select("date_key", "full_date"), "date_key", (lk.on_day(col("o_orderdate")),))
    return lk.look_up(table(spark, sf, "orders"), [lookup]).select("o_orderkey", "date_key")


def _request_lookup(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    staged = materialize(_requests(spark, sf), "staged")
    dims = request_dimensions(staged)
    dims["date"] = dim.dim_date(dim.days(staged, "created_date"))
    dims["geography"] = dim.dim_geography(dim.crash_regions(_clean_crashes(spark, sf)))
    names = {"geo_key": "geography", "complaint_key": "complaint", "channel_key": "channel", "status_key": "status"}
    dims |= _saved({names[k]: dims[names[k]] for k in keys})
    wanted = [lookup for lookup in request_lookups(dims) if lookup.key in keys]
    return lk.look_up(staged, wanted).select("complaint_id", *keys)


@query
def lookup_region_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return _request_lookup(spark, sf, "geo_key")


@query
def lookup_null_as_blank(spark: SparkSession, sf: str) -> DataFrame:
    return _request_lookup(spark, sf, "complaint_key")


@query
def lookup_strict_null(spark: SparkSession, sf: str) -> DataFrame:
    return _request_lookup(spark, sf, "channel_key", "status_key")


# What each crash dimension is made of, which is also what a collision is looked up by.
CRASH_MEMBERS = {
    "crash_time": (dim.dim_crash_time, "crash_date"),
    "factor": (dim.dim_factor, "contributing_factor_vehicle_1"),
    "vehicle": (dim.dim_vehicle, "vehicle_type_code1"),
}


def _crash_lookup(spark: SparkSession, sf: str, raw: Query = feeds.crashes, **wanted: str) -> DataFrame:
    """Only what the wanted lookups take goes through the deduplication: its sorts and its shuffle move whole rows."""
    cleaned = clean_crashes(raw(spark, sf), tiebreak=TIES)
    staged = materialize(cleaned.select("collision_id", *[CRASH_MEMBERS[name][1] for name in wanted.values()]), "staged")
    # Those that are not wanted are named, never run.
    dims = crash_dimensions(cleaned)
    dims["date"], dims["geography"] = dim.dim_date(dim.days(cleaned, "crash_date")), dim.dim_geography(dim.crash_regions(cleaned))
    dims |= _saved({name: CRASH_MEMBERS[name][0](staged) for name in wanted.values()})
    chosen = [lookup for lookup in crash_lookups(dims) if lookup.key in wanted]
    return lk.look_up(staged, chosen).select("collision_id", *wanted)


@query
def lookup_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _crash_lookup(spark, sf, crash_time_key="crash_time")


@query
def lookup_trim_default(spark: SparkSession, sf: str) -> DataFrame:
    return _crash_lookup(spark, sf, factor_key="factor", vehicle_type_key="vehicle")


@query
def lookup_trim_default_odd(spark: SparkSession, sf: str) -> DataFrame:
    """White space around members, a default that is one, NULL and hot keys."""
    return _crash_lookup(spark, sf, feeds.crashes_odd, factor_key="factor", vehicle_type_key="vehicle")


@query
def fact_requests_(spark: SparkSession, sf: str) -> DataFrame:
    staged = materialize(_requests(spark, sf), "staged")
    dims = request_dimensions(staged)
    dims["date"] = dim.dim_date(dim.days(staged, "created_date"))
    dims["geography"] = dim.dim_geography(dim.request_regions(staged))
    return fact_requests(staged, _saved(dims))


@query
def fact_crashes_(spark: SparkSession, sf: str) -> DataFrame:
    staged = _saved({"requests": _requests(spark, sf), "crashes": _crashes(spark, sf)})
    dims = crash_dimensions(staged["crashes"]) | shared_dimensions(staged["requests"], staged["crashes"])
    return fact_crashes(staged["crashes"], _saved(dims))


# ---- regions ----------------------------------------------------------------------------------


def _located(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw collision row with usable coordinates."""
    raw = feeds.crashes(spark, sf)
    spots = raw.select("source_row", *[clean.zero_to_null(col(c)).alias(c) for c in ("longitude", "latitude")])
    return spots.dropna(subset=["longitude", "latitude"])


def _points(spark: SparkSession, sf: str, with_near: bool = True, seed: Query = feeds.regions) -> tuple[DataFrame, rg.RegionIndex]:
    located = _located(spark, sf)
    x, y = rg.point(col("longitude"), col("latitude"))
    points = materialize(rg.as_points(located, "source_row", x, y, rg.CELL), "points")
    shapes = rg.parse_regions(seed(spark, sf))
    return points, rg.index_regions(rg.cells_of(points), shapes, with_near=with_near)


@query
def wkt_edges_(spark: SparkSession, sf: str) -> DataFrame:
    parsed = feeds.regions(spark, sf).select("zip_code", "borough", F.explode(wkt_edges(col("geom_wkt"))).alias("e"))
    return parsed.select("zip_code", "borough", "e.x1", "e.y1", "e.x2", "e.y2")


@query
def cross_regions(spark: SparkSession, sf: str) -> DataFrame:
    x, y = rg.point(col("longitude"), col("latitude"))
    cells = rg.occupied_cells(_located(spark, sf), x, y, 1 / 64)
    shapes = rg.parse_regions(feeds.regions(spark, sf))
    names = shapes.select("region_id", "derived_zip", "derived_borough", *rg.BOX)
    return rg.candidate_regions(cells, shapes, 1 / 64).join(names, "region_id").drop("region_id")


@query
def point_in_region(spark: SparkSession, sf: str) -> DataFrame:
    points, index = _points(spark, sf, with_near=False)
    return rg.containing(points, index, "source_row")


@query
def anti_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    points, index = _points(spark, sf, with_near=False)
    return rg.without_match(points, rg.containing(points, index, "source_row"), "source_row").select("source_row")


@query
def nearest_region(spark: SparkSession, sf: str) -> DataFrame:
    points, index = _points(spark, sf)
    rest = rg.without_match(points, rg.containing(points, index, "source_row"), "source_row")
    return rg.nearest(rest, index, "source_row")


@query
def point_in_region_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons of 240 vertices."""
    points, index = _points(spark, sf, False, feeds.regions_dense)
    return rg.containing(points, index, "source_row")


@query
def nearest_region_dense(spark: SparkSession, sf: str) -> DataFrame:
    points, index = _points(spark, sf, seed=feeds.regions_dense)
    rest = rg.without_match(points, rg.containing(points, index, "source_row"), "source_row")
    return rg.nearest(rest, index, "source_row")


@query
def region_lookup_union(spark: SparkSession, sf: str) -> DataFrame:
    points, index = _points(spark, sf)
    return rg.region_of(points, index, "source_row")


@query
def region_enrich(spark: SparkSession, sf: str) -> DataFrame:
    raw = feeds.crashes(spark, sf)
    rows = raw.select(
        "source_row",
        clean.clean_zip(col("zip_code")).alias("zip_code"),
        clean.clean_borough(col("borough")).alias("borough"),
        *[clean.zero_to_null(col(c)).alias(c) for c in ("longitude", "latitude")],
    )
    return rg.enrich_regions(rows, feeds.regions(spark, sf), "source_row")


@query
def region_enrich_split(spark: SparkSession, sf: str) -> DataFrame:
    """Beyond the broadcast budget, with a key that repeats and hot cells that are split."""
    raw = feeds.crashes(spark, sf)
    rows = raw.select(
        "source_row",
        col("collision_id").cast("string").alias("collision_id"),
        clean.clean_zip(col("zip_code")).alias("zip_code"),
        clean.clean_borough(col("borough")).alias("borough"),
        *[clean.zero_to_null(col(c)).alias(c) for c in ("longitude", "latitude")],
    )
    return rg.enrich_regions(rows, feeds.regions(spark, sf), "collision_id", budget=0).drop("collision_id")


@query
def star_except_enrich(spark: SparkSession, sf: str) -> DataFrame:
    raw = feeds.requests(spark, sf)
    cleaned = {
        "zip_code": clean.clean_zip(col("incident_zip")),
        "borough": clean.clean_borough(col("borough")),
        "latitude": clean.zero_to_null(col("latitude")),
        "longitude": clean.zero_to_null(col("longitude")),
    }
    rows = replace_columns(raw, ["incident_zip", *cleaned], cleaned)
    return rg.enrich_regions(rows, feeds.regions(spark, sf), "source_row", multi="first")


# ---- checks -----------------------------------------------------------------------------------


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(feeds.requests(spark, sf), "unique_key")


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing(feeds.requests(spark, sf), "created_date").select("source_row", "created_date")


@query
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphans(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


@query
def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unaccepted(table(spark, sf, "lineitem"), "l_linenumber", (1, 2, 3))


@query
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    requests, crashes = feeds.requests(spark, sf), feeds.crashes(spark, sf)
    seed = feeds.regions(spark, sf)
    tables = build_star(requests, crashes, seed, to_folder(scratch_path(spark, "star")), TIES, TIES)
    return run_checks(tables | {"raw_requests": requests, "raw_crashes": crashes})


# ---- the flagship -----------------------------------------------------------------------------


@query
def latest_order_holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Latest order per customer, its day looked up in a calendar of those days, counted by holiday flag."""
    scope = in_scope(table(spark, sf, "orders"), ("o_custkey", "o_orderdate"), ("o_orderdate", dt.date(1997, 1, 1)))
    latest = materialize(
        keep_latest(scope, "o_custkey", [col("o_orderdate").desc_nulls_last()], ["o_orderkey"]), "latest"
    )
    days = materialize(dim.dim_date(dim.days(latest, "o_orderdate")), "days")
    on = (lk.on_day(col("o_orderdate")),)
    wanted = [lk.Lookup(days.select(name, "full_date"), name, on) for name in ("date_key", "is_holiday")]
    return lk.look_up(latest, wanted).groupBy("is_holiday").agg(
        F.count("*").alias("n_orders"), F.count_distinct("date_key").alias("n_days")
    )
