import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from recordloom.operators.dedup import keep_latest, keep_latest_wide
from recordloom.operators.filters import in_scope

SCHEMA = "k string, t timestamp, v int"
DAY = dt.datetime(2024, 1, 1)


def _latest():
    return [F.col("t").desc_nulls_last()]


def test_latest_wins_and_ties_are_stable(spark):
    rows = [
        ("a", DAY, 1), ("a", DAY + dt.timedelta(1), 2), ("a", None, 3),
        ("b", DAY, 9), ("b", DAY, 4), ("c", None, 5), (None, DAY, 6), (None, DAY + dt.timedelta(1), 7),
    ]
    for order in (rows, rows[::-1]):
        got = {(r.k, r.v) for r in keep_latest(spark.createDataFrame(order, SCHEMA).repartition(5), "k", _latest()).collect()}
        assert got == {("a", 2), ("b", 4), ("c", 5), (None, 7)}


def test_groups_are_limited_before_the_shuffle(spark):
    plan = plan_of(keep_latest(spark.createDataFrame([("a", DAY, 1)], SCHEMA), "k", _latest()))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "Final" in before
    assert "WindowGroupLimit" in after and "Partial" in after


def test_columns_without_an_order_are_no_tiebreak(spark):
    df = spark.sql("SELECT 'a' AS k, TIMESTAMP '2024-01-01' AS t, map('x', 1) AS m, 1 AS v")
    assert keep_latest(df, "k", _latest()).count() == 1


def test_scope_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", dt.datetime(2019, 12, 31, 23, 59), "x"), ("b", dt.datetime(2020, 1, 1), "x"), (None, DAY, "x"), ("c", DAY, "X")]
    spark.createDataFrame(rows, "k string, t timestamp, c string").write.parquet(path)
    df = in_scope(spark.read.parquet(path), ("k", "t"), ("t", dt.date(2020, 1, 1)), {"c": "x"})
    assert [r.k for r in df.collect()] == ["b"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(df.select("k"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("IsNotNull(k)", "IsNotNull(t)", "GreaterThanOrEqual(t,2020-01-01", "EqualTo(c,x)"):
        assert part in pushed


def test_maps_break_ties_whatever_the_order_of_their_entries(spark):
    df = spark.sql("select * from values (1, map('a', map('x', 1), 'b', null)), (1, map('b', null, 'a', map('x', 0))) as t(k, m)")
    for rows in (df, df.orderBy(F.monotonically_increasing_id().desc())):
        assert [r.m["a"] for r in keep_latest(rows.repartition(2), "k", []).collect()] == [{"x": 0}]


def test_wide_rows_are_kept_alike_and_not_sorted(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", DAY + dt.timedelta(i * 37 % 50), i % 90, "payload" * 5) for i in range(200)]
    rows += [rows[-1]] * 40  # repeated in full
    df = spark.createDataFrame(rows, "k string, t timestamp, v int, wide string").repartition(6)
    want = sorted(map(tuple, keep_latest(df, "k", _latest(), ["v"]).collect()), key=repr)
    for options in ({}, {"budget": 0, "rows_per_task": 20}):
        out = keep_latest_wide(df, "k", _latest(), ["v"], **options)
        assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=repr) == want
        sorts = [line for line in plan_of(out).splitlines() if "Sort " in line or "SortAggregate" in line or "SortMergeJoin" in line]
        assert not [line for line in sorts if "wide" in line]
        assert "SortMergeJoin LeftSemi" not in plan_of(out)
    assert keep_latest_wide(df.limit(0), "k", _latest(), ["v"]).count() == 0
    maps = spark.sql("select * from values (1, map('a', 1), 5), (1, map('a', 0), 5) as t(k, m, v)")
    assert keep_latest_wide(maps.union(maps), "k", [], ["v"]).count() == 1
