"""The whole star: raw feeds in, every table out, in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ..operators.regions import CELL
from ..operators.rejects import split_rejects
from ..sources.scratch import temporary_tables
from ..sources.writers import database_for, write_path, write_table
from . import dimensions as dim
from .facts import fact_crashes, fact_requests
from .staging import stage_crashes, stage_requests

# Layer and published name of every table.
TABLES: dict[str, tuple[str, str]] = {
    "seed": ("seed", "nyc_zip_polygons"),
    "stg_requests": ("staging", "stg_311_illegal_parking"),
    "stg_crashes": ("staging", "stg_mvc_crashes"),
    "date": ("shared", "dim_date"),
    "geography": ("shared", "dim_geography_bucket"),
    "agency": ("requests", "dim_agency"),
    "channel": ("requests", "dim_channel"),
    "complaint": ("requests", "dim_complaint"),
    "status": ("requests", "dim_status"),
    "factor": ("crashes", "dim_contributing_factor"),
    "crash_time": ("crashes", "dim_crash_time"),
    "vehicle": ("crashes", "dim_vehicle_type"),
    "fact_requests": ("requests", "fact_311_illegal_parking"),
    "fact_crashes": ("crashes", "fact_mvc_crash"),
}

# What tolerant casts gave up, beside the staged tables.
REJECT_TABLES: dict[str, tuple[str, str]] = {
    f"rej_{feed}": (layer, f"{name}_rejects") for feed in ("requests", "crashes") for layer, name in [TABLES[f"stg_{feed}"]]
}

# Databases of the layers unless others are given; a layer mapped to None goes to the default database.
LAYERS: dict[str, str | None] = {
    "seed": "seed",
    "staging": "staging",
    "shared": "conformed_dimensions",
    "requests": "requests_mart",
    "crashes": "crashes_mart",
}

Save = Callable[[str, DataFrame], DataFrame]


def to_databases(layers: Mapping[str, str | None] | None = None, default: str = "default", fmt: str = "parquet") -> Save:
    """Save tables under their published names in the database of their layer."""

    def save(name: str, df: DataFrame) -> DataFrame:
        layer, table = (TABLES | REJECT_TABLES)[name]
        return write_table(df, table, database_for(layer, LAYERS if layers is None else layers, default), fmt)

    return save


def to_folder(root: str, fmt: str = "parquet") -> Save:
    """Save tables under their published names in folders named after their layer."""

    def save(name: str, df: DataFrame) -> DataFrame:
        layer, table = (TABLES | REJECT_TABLES)[name]
        return write_path(df, f"{root}/{layer}/{table}", fmt)

    return save


def save_all(frames: Mapping[str, DataFrame], save: Save) -> dict[str, DataFrame]:
    """Save independent tables at the same time, so that small jobs do not leave a cluster idle."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = {
            name: pool.submit(inheritable_thread_target(df.sparkSession)(save), name, df)
            for name, df in frames.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def request_dimensions(requests: DataFrame) -> dict[str, DataFrame]:
    return {
        "agency": dim.dim_agency(requests),
        "channel": dim.dim_channel(requests),
        "complaint": dim.dim_complaint(requests),
        "status": dim.dim_status(requests),
    }


def crash_dimensions(crashes: DataFrame) -> dict[str, DataFrame]:
    return {
        "factor": dim.dim_factor(crashes),
        "crash_time": dim.dim_crash_time(crashes),
        "vehicle": dim.dim_vehicle(crashes),
    }


def shared_dimensions(requests: DataFrame, crashes: DataFrame) -> dict[str, DataFrame]:
    return {
        "date": dim.dim_date(dim.days(requests, "created_date"), dim.days(crashes, "crash_date")),
        "geography": dim.dim_geography(dim.request_regions(requests), dim.crash_regions(crashes)),
    }


def build_star(
    requests: DataFrame,
    crashes: DataFrame,
    seed: DataFrame,
    save: Save,
    request_ties: list[str] | None = None,
    crash_ties: list[str] | None = None,
    multi: str = "all",
    cell: float = CELL,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Build and save every table; returns scans of the saved tables by name.

    With ``strict=False`` values that cannot be read become NULL, and ``rej_requests`` and ``rej_crashes`` list them by
    key, column, text and reason.

    Staging is written before anything reads it, so each feed is cleaned once, and the
    dimensions before the facts, so that their sizes are known when they are joined.
    Nothing but the saved tables stays behind; ``save`` must not return a scan of a scratch table.
    """
    with temporary_tables(seed.sparkSession):
        tables = {"seed": save("seed", seed)}
        staged = {
            "stg_requests": stage_requests(requests, tiebreak=request_ties, strict=strict, keep_rejects=not strict),
            "stg_crashes": stage_crashes(crashes, tables["seed"], crash_ties, multi, cell, strict, not strict),
        }
        if not strict:
            for feed in ("requests", "crashes"):
                staged[f"stg_{feed}"], staged[f"rej_{feed}"] = split_rejects(staged[f"stg_{feed}"])
        tables |= save_all(staged, save)
        req, cra = tables["stg_requests"], tables["stg_crashes"]
        tables |= save_all(shared_dimensions(req, cra) | request_dimensions(req) | crash_dimensions(cra), save)
        facts = {"fact_requests": fact_requests(req, tables), "fact_crashes": fact_crashes(cra, tables)}
        return tables | save_all(facts, save)
