import datetime as dt
import pathlib

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from recordloom.operators import quality
from recordloom.plans.checks import DECLARED, run_checks
from recordloom.plans.facts import fact_requests
from recordloom.plans.staging import stage_requests
from recordloom.plans.star import LAYERS, TABLES, build_star, to_databases, to_folder
from recordloom.sources import CRASHES, REQUESTS, scratch_dir
from test_geometry import HOLED, MULTI, PLAIN

NEW = dt.datetime(2024, 5, 27, 9, 30)


def _frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _requests(spark, *more):
    base = dict(
        unique_key="1", created_date=NEW, agency="PD", agency_name="Police", complaint_type="Illegal Parking",
        descriptor="Blocked", location_type="Street", status=" open ", incident_zip="10001", borough="MANHATTAN",
        latitude="40.1", longitude="-74.1", open_data_channel_type="PHONE", city="NY",
    )
    rows = [
        base,
        base | {"created_date": NEW - dt.timedelta(1), "status": "Closed"},
        base | {"unique_key": "2", "descriptor": None, "agency": None, "open_data_channel_type": None, "status": None, "borough": "x"},
        base | {"unique_key": "3", "created_date": dt.datetime(2019, 12, 31)},
        base | {"unique_key": "4", "complaint_type": "illegal parking"},
        base | {"unique_key": None}, base | {"unique_key": "5", "created_date": None}, *more,
    ]
    return _frame(spark, REQUESTS, rows)


def _crashes(spark):
    base = dict(
        collision_id="100", crash_date=dt.datetime(2015, 11, 26), crash_time="7:05", borough="QUEENS", zip_code="11101",
        latitude="40.25", longitude="-73.75", number_of_persons_injured=2, number_of_persons_killed=0,
        contributing_factor_vehicle_1=" Glare ", vehicle_type_code1="Sedan",
    )
    rows = [
        base,
        base | {"crash_time": "6:00"},
        base | {"collision_id": "101", "borough": None, "zip_code": None, "crash_time": None, "vehicle_type_code1": " "},
        base | {"collision_id": "102", "borough": "", "zip_code": "N/A", "longitude": "-74.35", "latitude": "40.85"},
        base | {"collision_id": "103", "zip_code": None, "latitude": "0", "contributing_factor_vehicle_1": None},
        base | {"collision_id": None, "zip_code": None}, base | {"collision_id": None, "zip_code": None},
    ]
    return _frame(spark, CRASHES, rows)


def _seed(spark):
    rows = [("10001", "Manhattan", HOLED), ("11201", "Brooklyn", MULTI), ("99999", "Queens", PLAIN)]
    return spark.createDataFrame(rows, "zip_code string, borough string, geom_wkt string")


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    return build_star(_requests(spark), _crashes(spark), _seed(spark), to_folder(root))


def test_staged_requests(star):
    staged = star["stg_requests"]
    assert staged.columns[:3] == ["additional_details", "intersection_street_1", "intersection_street_2"]
    assert staged.columns[15:17] == ["complaint_id", "created_date"] and staged.columns[-1] == "_stg_loaded_at"
    rows = {r.complaint_id: r for r in staged.collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"].status, rows["1"].borough, rows["1"].city) == ("OPEN", "Manhattan", "NY")
    assert (rows["2"].status, rows["2"].borough) == (None, "UNKNOWN or CITYWIDE")


def test_staged_crashes(star):
    staged = star["stg_crashes"]
    assert staged.columns[-3:] == ["_stg_loaded_at", "zip_code", "borough"]
    rows = {r.collision_id: (r.zip_code, r.borough, r.crash_date, r.crash_time) for r in staged.collect()}
    assert rows == {
        "100": ("11101", "Queens", dt.datetime(2015, 11, 26, 7, 5), "7:05"),
        "101": ("11201", "Brooklyn", None, None),
        "102": (None, "Queens", dt.datetime(2015, 11, 26, 7, 5), "7:05"),
        "103": (None, "Queens", dt.datetime(2015, 11, 26, 7, 5), "7:05"),
        None: (None, "Queens", dt.datetime(2015, 11, 26, 7, 5), "7:05"),
    }


def test_dimensions(star):
    assert {(r.full_date, r.is_holiday) for r in star["date"].collect()} == {
        (dt.date(2024, 5, 27), True), (dt.date(2015, 11, 26), True),
    }
    assert {(r.borough, r.zip_code) for r in star["geography"].collect()} == {
        ("Manhattan", "10001"), ("UNKNOWN", "10001"), ("Queens", "11101"), ("Brooklyn", "11201"), ("Queens", "UNKNOWN"),
    }
    assert {r.method_of_submission for r in star["channel"].collect()} == {"PHONE", None}
    assert {r.status for r in star["status"].collect()} == {"OPEN"}
    assert {(r.hour, r.time_band) for r in star["crash_time"].collect()} == {(7, "Morning")}
    assert {r.factor_desc for r in star["factor"].collect()} == {"Glare"}
    assert {r.vehicle_type_desc for r in star["vehicle"].collect()} == {"Sedan"}


def test_facts(star):
    requests = {r.complaint_id: r for r in star["fact_requests"].collect()}
    assert len(requests) == 2 and requests["1"].status_key and requests["2"].complaint_key
    assert (requests["2"].agency_key, requests["2"].channel_key, requests["2"].status_key) == (None, None, None)
    crashes = {r.collision_id: r for r in star["fact_crashes"].collect()}
    assert len(crashes) == 5
    assert crashes["101"].date_key is None and crashes["101"].vehicle_type_key is None and crashes["101"].geo_key
    assert crashes["103"].factor_key is None and crashes["100"].factor_key
    assert {r.crash_count for r in crashes.values()} == {1} and crashes["100"].number_of_persons_injured == 2


def test_declared_checks(star, spark):
    kinds = [k.kind for k in DECLARED]
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 31, "unique": 25, "relationships": 11, "accepted_values": 1}
    tables = star | {"raw_requests": _requests(spark), "raw_crashes": _crashes(spark)}
    report = run_checks(tables).collect()
    assert len(report) == 68
    failed = {(r.table_name, r.column_name, r.check_name): r.failures for r in report if r.failures}
    # Keys of dimensions repeat in a fact, though they are declared unique.
    repeated = {k for k in failed if k[0] == "fact_crashes" and k[2] == "unique"}
    assert {k[1] for k in repeated} <= {"date_key", "geo_key", "crash_time_key", "factor_key", "vehicle_type_key"} and repeated
    assert {k: n for k, n in failed.items() if k not in repeated} == {
        ("raw_requests", "unique_key", "unique"): 1, ("raw_requests", "unique_key", "not_null"): 1,
        ("raw_crashes", "collision_id", "not_null"): 2, ("stg_crashes", "collision_id", "not_null"): 1,
        ("fact_crashes", "collision_id", "not_null"): 1, ("fact_crashes", "date_key", "not_null"): 1,
        ("fact_crashes", "crash_time_key", "not_null"): 1, ("fact_crashes", "factor_key", "not_null"): 1,
        ("fact_crashes", "vehicle_type_key", "not_null"): 1,
    }


def test_null_and_blank_descriptor_fan_out_is_reported(spark, tmp_path):
    blank = dict(_requests(spark).collect()[0].asDict(), unique_key="9", descriptor="", created_date=NEW)
    star = build_star(_requests(spark, blank), _crashes(spark), _seed(spark), to_folder(str(tmp_path)))
    assert star["stg_requests"].count() == 3 and star["fact_requests"].count() == 5
    doubled = quality.duplicates(star["fact_requests"], "fact_illegal_parking_key").collect()
    assert [r.n_rows for r in doubled] == [2, 2]


def test_only_the_tables_stay_and_loading_times_are_one(spark, tmp_path):
    scratch = pathlib.Path(scratch_dir(spark).removeprefix("file:"), "recordloom")
    before = set(scratch.glob("*"))
    star = build_star(_requests(spark), _crashes(spark), _seed(spark), to_folder(str(tmp_path)))
    assert set(scratch.glob("*")) == before
    for name in ("stg_requests", "stg_crashes"):
        times = star[name].agg(F.count("_stg_loaded_at").alias("n"), F.count("*").alias("rows"), F.count_distinct("_stg_loaded_at").alias("times"))
        assert times.first().n == times.first().rows and times.first().times == 1


def test_checks_see_failures(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "b"), (3, "z")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    assert [tuple(r) for r in quality.duplicates(child, "id").collect()] == [(2, 2)]
    assert quality.missing(child, "k").count() == 1
    assert {tuple(r) for r in quality.missing_counts(child, ["id", "k"]).collect()} == {("id", 1), ("k", 1)}
    assert [tuple(r) for r in quality.orphans(child, "k", parent, "p").collect()] == [("z", 1)]
    assert [tuple(r) for r in quality.unaccepted(child, "id", [1, 2]).collect()] == [(3, 1)]


def test_large_dimensions_give_the_same_fact(star):
    small = fact_requests(star["stg_requests"], star)
    large = fact_requests(star["stg_requests"], star, budget=0, rows_per_task=1)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    assert plan_of(small).count("BroadcastHashJoin") == 6 and "hashpartitioning" not in plan_of(small)


def test_databases(spark):
    layers = {k: f" rl_{v} " for k, v in LAYERS.items()} | {"shared": None}
    names = {layer: (layers[layer] or "default").strip() for layer in layers}
    try:
        build_star(_requests(spark), _crashes(spark), _seed(spark), to_databases(layers))
        for layer, table in TABLES.values():
            assert spark.catalog.tableExists(f"{names[layer]}.{table}")
    finally:
        for db in set(names.values()) - {"default"}:
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        for layer, table in TABLES.values():
            spark.sql(f"DROP TABLE IF EXISTS default.{table}")


def test_filters_come_before_the_deduplication(spark):
    base = _requests(spark).collect()[0].asDict()
    rows = [base | {"unique_key": "7"}, base | {"unique_key": "7", "created_date": NEW + dt.timedelta(9), "complaint_type": "Other"}]
    staged = stage_requests(_frame(spark, REQUESTS, rows)).collect()
    assert [r.created_date for r in staged] == [NEW]


def test_staging_limits_types(star):
    types = dict(star["stg_crashes"].dtypes)
    assert types["latitude"] == types["longitude"] == "decimal(38,9)" and types["crash_date"] == "timestamp"
    assert star["fact_crashes"].filter(F.col("collision_id").isNull()).count() == 1


def test_values_that_cannot_be_read_are_listed(spark, tmp_path):
    bad = dict(
        unique_key="8", created_date=NEW, complaint_type="Illegal Parking", borough="BRONX", latitude="forty", longitude="", incident_zip="1000",
    )
    requests = _frame(spark, REQUESTS, [bad, bad | {"created_date": NEW - dt.timedelta(2), "latitude": "older"}, bad | {"unique_key": "9", "latitude": "40.5", "longitude": None}])
    row = dict(collision_id="200", crash_date=dt.datetime(2015, 11, 26), crash_time="noon", borough="QUEENS", zip_code="11101", latitude="0", longitude="x")
    crashes = _frame(spark, CRASHES, [row, row | {"collision_id": "201", "crash_time": None, "longitude": "-73.75"}])
    star = build_star(requests, crashes, _seed(spark), to_folder(str(tmp_path)), strict=False)
    assert {tuple(r) for r in star["rej_requests"].collect()} == {("8", "latitude", "forty", "no number"), ("8", "longitude", "", "no number")}
    assert {tuple(r) for r in star["rej_crashes"].collect()} == {
        ("200", "longitude", "x", "no number"), ("200", "crash_date", "2015-11-26 00:00:00 noon", "no day and clock"),
    }
    # What a column lost is what is listed.
    staged, lost = star["stg_requests"], star["rej_requests"].groupBy("column").count().collect()
    given = {"latitude": 2, "longitude": 1}
    assert {r["column"]: r["count"] for r in lost} == {c: n - staged.filter(F.col(c).isNotNull()).count() for c, n in given.items()}
    assert "_rejects" not in staged.columns + star["stg_crashes"].columns


def test_unique_keys_are_shuffled_as_hashes(spark):
    """And values that share a hash are told apart: only equal values count."""
    from recordloom.plans import checks as module

    df = spark.createDataFrame([(str(i % 40), i, None if i % 10 == 0 else "x") for i in range(50)], "a string, b int, c string")
    declared = [module.Check("t", c, kind) for c in "abc" for kind in ("unique", "not_null")]
    want = {("a", "unique"): 10, ("a", "not_null"): 0, ("b", "unique"): 0, ("b", "not_null"): 0, ("c", "unique"): 1, ("c", "not_null"): 5}
    assert {(r.column_name, r.check_name): r.failures for r in run_checks({"t": df}, declared).collect()} == want
    plan = plan_of(module._hash_counts(0, df, ["a", "b"]))
    exchanged = plan[plan.index("Exchange"):]
    assert "Exchange hashpartitioning(i#" in exchanged and "a#" not in exchanged.split("\n")[0]
    assert {r.failures for r in run_checks({"t": df.limit(0)}, declared).collect()} == {0}


def test_values_that_share_a_hash_are_no_duplicates(spark, monkeypatch):
    from recordloom.plans import checks as module

    plain = F.xxhash64
    monkeypatch.setattr(module.F, "xxhash64", lambda *c: plain(*c) % 3)
    df = spark.createDataFrame([(i,) for i in [*range(20), 5]], "a int")
    report = run_checks({"t": df}, [module.Check("t", "a", "unique")]).collect()
    assert [r.failures for r in report] == [1]
