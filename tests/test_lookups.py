import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from recordloom.operators import lookups as lk

c = F.col


def _look(feed, dim, key, *on, **options):
    both = [
        sorted(map(tuple, lk.look_up(feed, [lk.Lookup(dim, key, on)], **o).collect()), key=repr)
        for o in (options, options | {"budget": 0, "rows_per_task": 1})
    ]
    assert both[0] == both[1]
    return both[0]


def test_strict_never_matches_null(spark):
    feed = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "z")], "id int, m string")
    dim = spark.createDataFrame([("ka", "a"), ("kn", None), ("kb", "")], "key string, m string")
    assert _look(feed, dim, "key", lk.strict(c("m"), "m")) == [(1, "a", "ka"), (2, None, None), (3, "", "kb"), (4, "z", None)]


def test_null_as_blank_matches_both_ways_and_fans_out(spark):
    feed = spark.createDataFrame([(1, "t", None), (2, "t", ""), (3, "t", "d"), (4, None, "d")], "id int, t string, d string")
    dim = spark.createDataFrame([("kn", "t", None), ("kb", "t", ""), ("kd", "t", "d")], "key string, t string, d string")
    got = _look(feed, dim, "key", lk.strict(c("t"), "t"), lk.null_as_blank(c("d"), "d"))
    assert got == [
        (1, "t", None, "kb"), (1, "t", None, "kn"), (2, "t", "", "kb"), (2, "t", "", "kn"), (3, "t", "d", "kd"),
        (4, None, "d", None),
    ]


def test_unknown_region(spark):
    feed = spark.createDataFrame(
        [(1, "10001", "Bronx"), (2, None, "UNKNOWN or CITYWIDE"), (3, None, None), (4, "10001", "Queens")], "id int, z string, b string"
    )
    dim = spark.createDataFrame([("k1", "Bronx", "10001"), ("k2", "UNKNOWN", "UNKNOWN")], "geo_key string, borough string, zip_code string")
    got = _look(feed, dim, "geo_key", *lk.unknown_region(c("z"), c("b")))
    assert [r[-1] for r in got] == ["k1", "k2", None, None]


def test_trim_and_default(spark):
    feed = spark.createDataFrame([(1, " Glare\t"), (2, None), (3, " "), (4, "Unspecified")], "id int, f string")
    dim = spark.createDataFrame([("kg", "Glare"), ("ku", "Unspecified")], "key string, f string")
    got = _look(feed, dim, "key", lk.trimmed_or_default(c("f"), "f", "Unspecified"))
    assert [r[-1] for r in got] == ["kg", "ku", None, "ku"]
    assert [r[-1] for r in _look(feed, dim, "key", lk.trimmed_or_default(c("f"), "f", "UNKNOWN"))] == ["kg", None, None, "ku"]


def test_day_and_hour(spark):
    feed = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 23, 5)), (2, None), (3, dt.datetime(2023, 1, 2, 1, 0))], "id int, t timestamp")
    days = spark.createDataFrame([("kd", dt.date(2024, 1, 2))], "date_key string, full_date date")
    hours = spark.createDataFrame([("kh", 23)], "crash_time_key string, hour bigint")
    assert [r[-1] for r in _look(feed, days, "date_key", lk.on_day(c("t")))] == ["kd", None, None]
    assert [r[-1] for r in _look(feed, hours, "crash_time_key", lk.on_hour(c("t")))] == ["kh", None, None]


def test_several_small_dimensions_shuffle_nothing(spark):
    feed = spark.createDataFrame([(1, "a", "b")], "id int, x string, y string")
    dim = spark.createDataFrame([("k", "a")], "key string, m string")
    lookups = [
        lk.Lookup(dim.withColumnRenamed("key", name), name, (lk.strict(c(col), "m"),)) for name, col in (("kx", "x"), ("ky", "y"))
    ]
    df = lk.look_up(feed, lookups)
    assert df.columns == ["id", "x", "y", "kx", "ky"] and [tuple(r) for r in df.collect()] == [(1, "a", "b", "k", None)]
    plan = plan_of(df)
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan


def test_budget_is_shared_by_all_dimensions(spark):
    assert lk._shared_budget([5, 1, 4, 2], 7) == [8, 1, 4, 2]
    assert lk._shared_budget([20 << 20] * 6, 64 << 20).count(20 << 20) == 3
    feed = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, m string")
    dims = [spark.createDataFrame([(f"k{i}", "a" * (1 + i)), ("kz", "z")], f"key{i} string, m string") for i in range(3)]
    looks = [lk.Lookup(d, f"key{i}", (lk.strict(c("m"), "m"),)) for i, d in enumerate(dims)]
    plenty, scarce = lk.look_up(feed, looks), lk.look_up(feed, looks, budget=150)
    assert sorted(map(tuple, plenty.collect()), key=repr) == sorted(map(tuple, scarce.collect()), key=repr)
    assert sorted(map(tuple, plenty.collect()))[0] == (1, "a", "k0", None, None)


def test_several_large_dimensions_shuffle_the_feed_once(spark):
    """With NULLs, values of a third of all rows, members that repeat, and keys of several types."""
    days = [dt.datetime(2024, 1, 1 + i % 5, i % 24) for i in range(90)]
    feed = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else f"v{i % 7}", None if i % 5 == 0 else f" f{i % 4}", days[i], "payload") for i in range(90)],
        "id int, m string, d string, t timestamp, wide string",
    )
    dims = [
        spark.createDataFrame([("k1", "hot"), ("k2", "v1"), ("k3", "v1"), (None, "v2")], "key1 string, m string"),
        spark.createDataFrame([(1, None), (2, " f1"), (3, "")], "key2 int, m string"),
        spark.createDataFrame([(True, dt.date(2024, 1, 2)), (False, dt.date(2024, 1, 3))], "key3 boolean, full_date date"),
        spark.createDataFrame([("h", 23)], "key4 string, hour bigint"),
    ]
    looks = [
        lk.Lookup(dims[0], "key1", (lk.strict(c("m"), "m"),)),
        lk.Lookup(dims[1], "key2", (lk.null_as_blank(c("d"), "m"),)),
        lk.Lookup(dims[2], "key3", (lk.on_day(c("t")),)),
        lk.Lookup(dims[3], "key4", (lk.on_hour(c("t")),)),
    ]
    plenty, scarce = lk.look_up(feed, looks), lk.look_up(feed, looks, budget=0, rows_per_task=4)
    assert plenty.schema == scarce.schema
    got = sorted(map(tuple, scarce.collect()), key=repr)
    assert got == sorted(map(tuple, plenty.collect()), key=repr) and len(got) > 90
    moved = [part for part in plan_of(scarce).split("Exchange ")[1:] if "wide" in part]
    assert plan_of(scarce).count("Exchange ") <= 2 and len(moved) <= 1


def test_crash_lookups_deduplicate_what_they_take_and_no_more(spark, monkeypatch):
    from workload import queries

    feed = spark.createDataFrame(
        [(1, "2020-01-01", "1:00", "b", 1.0), (1, "2020-01-02", "2:00", "a", 2.0), (None, "2020-01-03", "3:00", "c", 3.0)],
        "collision_id bigint, crash_date string, crash_time string, source_row string, latitude double",
    )
    others = ["borough", "zip_code", "on_street_name", "off_street_name", "cross_street_name", "contributing_factor_vehicle_1", "vehicle_type_code1"]
    feed = feed.withColumns({c: F.lit("x") for c in others} | {"longitude": F.lit(1.0)})
    feed = feed.withColumn("crash_date", F.col("crash_date").cast("timestamp"))
    written = {}
    real = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, name="table": written.setdefault(name, real(df, name)))
    found = queries._crash_lookup(spark, "", lambda *_: feed, crash_time_key="crash_time")
    assert written["staged"].columns == ["collision_id", "crash_date"]
    assert sorted(map(str, written["staged"].collect())) == [
        "Row(collision_id='1', crash_date=datetime.datetime(2020, 1, 2, 2, 0))",
        "Row(collision_id=None, crash_date=datetime.datetime(2020, 1, 3, 3, 0))",
    ]
    assert found.columns == ["collision_id", "crash_time_key"] and found.filter("crash_time_key is not null").count() == 2
