import math
import random
from collections import Counter

import pytest
from brute import contains, edges_of, regions_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from conftest import plan_of
from test_geometry import HOLED, MULTI, PLAIN

from recordloom.functions.geometry import with_polygon
from recordloom.operators import regions as rg

SEED = "zip_code string, borough string, geom_wkt string"
FIXED = [("10001", "Manhattan", HOLED), ("11201", "Brooklyn", MULTI), ("99999", "Queens", PLAIN)]
OVERLAP = ("10002", "Manhattan", "POLYGON((-74.2 40.3, -74 40.3, -74 40.5, -74.2 40.5, -74.2 40.3))")


def _random_seed(rng, n, x0, y0, x1, y1, largest):
    seed = []
    for i in range(n):
        cx, cy = rng.uniform(x0, x1), rng.uniform(y0, y1)
        w, h = rng.uniform(largest / 50, largest), rng.uniform(largest / 50, largest)
        corners = [(cx - w, cy - h), (cx + w, cy - h), (cx + w * rng.random(), cy + h), (cx - w, cy + h * rng.random())]
        text = ", ".join(f"{a:.4f} {b:.4f}" for a, b in [*corners, corners[0]])
        seed.append((f"{i:05d}", rng.choice("ABCDE"), f"POLYGON(({text}))"))
    return seed


def _derive(spark, seed, points, cell, **options):
    df = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points)], "id string, lon double, lat double")
    x, y = rg.point(F.col("lon"), F.col("lat"))
    index = rg.index_regions(rg.occupied_cells(df, x, y, cell), rg.parse_regions(spark.createDataFrame(seed, SEED)), cell)
    rows = rg.with_region(df, index, "id", x, y, F.lit(True), **options).collect()
    return Counter((int(r.id), r.derived_zip, r.derived_borough) for r in rows)


def _expected(seed, points, multi="all"):
    found = Counter()
    for i, p in enumerate(points):
        hits = regions_of(seed, *p) or [(None, None)]
        found.update((i, *h) for h in (hits if multi == "all" else hits[:1]))
    return found


WORLDS = {
    "city": ((-74.3, 40.4, -73.6, 41.0, 0.05), (-74.6, 40.2, -73.4, 41.2)),
    "continent": ((-120, 20, -60, 60, 3.0), (-179, -89, 179, 89)),
    "equator": ((-2, -2, 2, 2, 0.5), (-6, -6, 6, 6)),
    "north": ((10, 80, 60, 89, 2.0), (-20, 75, 120, 89.9)),
}


@pytest.mark.parametrize("world", WORLDS)
@pytest.mark.parametrize("cell", [1 / 64, 1 / 4])
def test_matches_brute_force(spark, world, cell):
    rng = random.Random(f"{world}{cell}")
    area, spread = WORLDS[world]
    seed = _random_seed(rng, 60, *area)
    points = [(rng.uniform(spread[0], spread[2]), rng.uniform(spread[1], spread[3])) for _ in range(250)]
    points += [(round(rng.uniform(area[0], area[2]), 4), round(rng.uniform(area[1], area[3]), 4)) for _ in range(250)]
    assert _derive(spark, seed, points, cell) == _expected(seed, points)


def test_sizes_far_apart_and_stacked_copies(spark):
    rng = random.Random(5)
    seed = _random_seed(rng, 20, -74.2, 40.5, -73.8, 40.9, 0.01)
    seed += [("big", "Z", "POLYGON((-100 20, -80 20, -80 50, -100 50, -100 20))")]
    seed += [("twin", "Y", "POLYGON((-73.9 41, -73.8 41, -73.8 41.1, -73.9 41.1, -73.9 41))")] * 3
    points = [(rng.uniform(-110, -60), rng.uniform(10, 60)) for _ in range(150)]
    points += [(rng.uniform(-74.3, -73.7), rng.uniform(40.4, 41.2)) for _ in range(150)]
    expected = _expected(seed, points)
    assert max(expected.values()) == 3
    assert _derive(spark, seed, points, 1 / 64) == expected


@pytest.mark.parametrize("multi", ["all", "first"])
def test_large_tables_take_the_split_shuffle(spark, multi):
    rng = random.Random(9)
    seed = _random_seed(rng, 40, -74.3, 40.4, -73.6, 41.0, 0.08)
    hot = (-73.95, 40.7)
    points = [hot] * 300 + [(rng.uniform(-74.6, -73.4), rng.uniform(40.2, 41.2)) for _ in range(300)]
    expected = _expected(seed, points, multi)
    assert _derive(spark, seed, points, 1 / 64, multi=multi) == expected
    assert _derive(spark, seed, points, 1 / 64, multi=multi, budget=0, rows_per_task=50) == expected


def test_fixture_shapes_with_points_on_their_borders(spark):
    points = [(-74.5 + i / 100, 40 + j / 100) for i in range(0, 121, 3) for j in range(0, 111, 5)]
    points = [(round(a, 2), round(b, 2)) for a, b in points]
    for seed in (FIXED, [*FIXED, OVERLAP]):
        assert _derive(spark, seed, points, 1 / 64) == _expected(seed, points)


def test_no_regions_at_all(spark):
    assert _derive(spark, [("1", "A", "POLYGON EMPTY")], [(1.0, 2.0)], 1 / 64) == Counter({(0, None, None): 1})


def _rows(spark):
    data = [
        ("1", None, None, -74.25, 40.45), ("2", "12345", None, -74.25, 40.45), ("3", None, "Bronx", -74.25, 40.45),
        ("4", "12345", "Bronx", -74.25, 40.45), ("5", None, None, None, 40.45), (None, None, None, -74.25, 40.45),
        ("6", "99999", "Bronx", None, None), ("7", None, None, -74.35, 40.85), ("8", None, None, -74.35, 40.15),
        ("9", None, None, -74.1, 40.4),
    ]
    return spark.createDataFrame(data, "collision_id string, zip_code string, borough string, longitude double, latitude double")


def test_fill_rules(spark):
    seed = spark.createDataFrame([*FIXED, OVERLAP], SEED)
    out = rg.enrich_regions(_rows(spark), seed, "collision_id")
    assert out.columns == ["collision_id", "longitude", "latitude", "zip_code", "borough"]
    got = Counter((r.collision_id, r.zip_code, r.borough) for r in out.collect())
    assert got == Counter(
        [
            ("1", "10001", "Manhattan"), ("2", "12345", "Manhattan"), ("3", "10001", "Bronx"), ("4", "12345", "Bronx"),
            ("5", None, "UNKNOWN or CITYWIDE"), (None, None, "UNKNOWN or CITYWIDE"), ("6", None, "Bronx"),
            ("7", None, "Queens"), ("8", "10001", "Manhattan"), ("9", "10001", "Manhattan"), ("9", "10002", "Manhattan"),
        ]
    )
    first = rg.enrich_regions(_rows(spark), seed, "collision_id", multi="first")
    assert first.count() == 10
    split = rg.enrich_regions(_rows(spark), seed, "collision_id", budget=0)
    assert Counter((r.collision_id, r.zip_code, r.borough) for r in split.collect()) == got


def test_repeated_keys_get_their_own_points_on_both_sides_of_the_budget(spark):
    seed = spark.createDataFrame([*FIXED, OVERLAP], SEED)
    rows = _rows(spark).withColumn("collision_id", F.lit("same"))
    got = [
        Counter(map(tuple, rg.enrich_regions(rows, seed, "collision_id", budget=budget).collect()))
        for budget in (rg.BROADCAST_BYTES, 0)
    ]
    assert got[0] == got[1] and sum(got[0].values()) == 11


def test_only_surviving_rows_need_valid_coordinates(spark):
    seed, rows = spark.createDataFrame(FIXED, SEED), _rows(spark)
    bad = spark.createDataFrame([("1", None, None, -74.25, 91.0)], rows.schema)
    for budget in (rg.BROADCAST_BYTES, 0):
        ok = rg.enrich_regions(rows, seed, "collision_id", places=rows.union(bad), budget=budget)
        assert ok.count() == rows.count()
        with pytest.raises(PySparkException):
            rg.enrich_regions(rows.union(bad), seed, "collision_id", places=rows.union(bad), budget=budget).collect()


def test_rows_do_not_move(spark):
    plan = plan_of(rg.enrich_regions(_rows(spark), spark.createDataFrame(FIXED, SEED), "collision_id"))
    assert plan.count("BroadcastHashJoin") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan


def test_coordinates_are_checked(spark, values):
    df = spark.createDataFrame([(286.0, 10.0), (-434.0, 10.0), (180.0, 10.0), (-74.0, 10.0)], "lon double, lat double")
    x, y = rg.point(F.col("lon"), F.col("lat"))
    assert [r[0] for r in df.select(x).collect()] == [-74.0, -74.0, 180.0, -74.0]
    bad = spark.createDataFrame([(0.0, 90.5)], "lon double, lat double")
    with pytest.raises(PySparkException):
        bad.select(y).collect()
    assert bad.select(rg.point(F.col("lon"), F.col("lat"), strict=False)[1]).collect()[0][0] is None


def test_cell_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        rg._top_level(0.01)


def test_bad_texts_fail_or_are_reported(spark):
    seed = spark.createDataFrame(
        [*FIXED, ("1", "Bronx", "POLYGON((0 0, 1 0, 1 1, 0 0)"), ("2", "Bronx", "LINESTRING(0 0, 1 1)"), ("3", "Bronx", None)], SEED
    )
    with pytest.raises(PySparkException, match="region text"):
        rg.parse_regions(seed)
    assert rg.parse_regions(seed, strict=False).count() == len(FIXED)
    assert {r.zip_code for r in rg.unreadable_regions(seed).collect()} == {"1", "2"}


def _square(side, cell):
    """A square of ``side`` x ``side`` cells whose borders lie inside cells, and a point in each of its cells."""
    a, b = 0.3 * cell, (side + 0.3) * cell
    ring = ", ".join(f"{x:.9f} {y:.9f}" for x, y in [(a, a), (b, a), (b, b), (a, b), (a, a)])
    points = [((i + 0.5) * cell, (j + 0.5) * cell) for i in range(side + 1) for j in range(side + 1)]
    return [("1", "A", f"POLYGON(({ring}))")], points


def _index(spark, seed, points, cell, with_near=True):
    df = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points)], "id string, lon double, lat double")
    found = rg.as_points(df, "id", *rg.point(F.col("lon"), F.col("lat")), cell)
    return found, rg.index_regions(rg.cells_of(found), rg.parse_regions(spark.createDataFrame(seed, SEED)), cell, with_near)


def test_a_region_adds_rows_in_proportion_to_its_border(spark):
    cell, rows = 1 / 128, {}
    for side in (50, 100):
        seed, points = _square(side, cell)
        found, index = _index(spark, seed, points, cell, with_near=False)
        rows[side] = index.inside.count()
        got = {int(r.id) for r in rg.containing(found, index, "id").collect()}
        assert got == {i for i, p in enumerate(points) if contains(edges_of(seed[0][2]), *p)}
        assert index.inside.filter("whole").agg(F.sum(F.expr("shiftleft(1L, level)"))).first()[0] == (side - 1) ** 2
    assert rows[100] < 0.2 * 100**2 and rows[100] < 2.5 * rows[50]


def test_tiles_make_up_their_run(spark):
    rng = random.Random(1)
    runs = [(a, a + rng.choice([0, 1, 2, 3, 5, 10, 50, 3000])) for a in (rng.randint(-5000, 5000) for _ in range(300))]
    df = spark.createDataFrame([([r],) for r in runs], "runs array<struct<first bigint, last bigint>>")
    for r in df.select("runs", rg._tiles_of_runs("runs", 1 / 128).alias("t")).collect():
        first, last = r.runs[0]
        assert sorted(c for level, t in r.t for c in range(t << level, (t + 1) << level)) == list(range(first, last + 1))
        assert max(Counter(level for level, _ in r.t).values()) <= 6


def test_far_cells_share_the_segments_of_their_unit(spark):
    cell = 1 / 64
    seed, _ = _square(4, cell)
    points = [(20 + i * cell + cell / 2, 30 + j * cell + cell / 2) for i in range(40) for j in range(40)]
    found, index = _index(spark, seed, points, cell)
    assert index.units.count() == 1600
    assert index.near.select(*rg.NEAR_KEY).distinct().count() * 100 < 1600
    assert rg.nearest(found, index, "id").count() == 1600


def test_polygon_texts_are_cut_once(spark, tmp_path):
    path = str(tmp_path / "seed")
    spark.createDataFrame(FIXED, SEED).write.parquet(path)
    plan = plan_of(with_polygon(spark.read.parquet(path).withColumn("w", F.concat("geom_wkt", F.lit(""))), "w").select("edges", "problem"))
    assert plan.count("(?<=[()])") == 1 and plan.count("concat(geom_wkt") == 1


def test_containment_is_worked_out_once_for_the_anti_join(spark):
    cell = 1 / 64
    points = [(-74.5 + i / 40, 40 + j / 40) for i in range(20) for j in range(20)]
    found, index = _index(spark, FIXED, points, cell)
    hits = rg.containing(found, index, "id")
    rest = rg.without_match(found, hits, "id")
    assert {int(r.id) for r in rest.collect()} == {i for i, p in enumerate(points) if not any(contains(edges_of(w), *p) for *_, w in FIXED)}
    assert plan_of(rest).count("whole") == 0  # the matches were written


def test_far_and_hidden_vertices(spark):
    """Polygons of hundreds of vertices, some of them long and thin, against brute force."""
    rng = random.Random(11)
    seed = []
    for i in range(8):
        cx, cy, n = rng.uniform(-74.2, -73.8), rng.uniform(40.5, 40.9), 300
        radii = [rng.uniform(0.02, 0.12) for _ in range(n)]
        ring = [(cx + r * math.cos(2 * math.pi * k / n) * 1.5, cy + r * math.sin(2 * math.pi * k / n) * 0.4) for k, r in enumerate(radii)]
        seed.append((f"{i}", "ABC"[i % 3], "POLYGON((" + ", ".join(f"{a:.6f} {b:.6f}" for a, b in [*ring, ring[0]]) + "))"))
    points = [(rng.uniform(-74.4, -73.6), rng.uniform(40.4, 41.0)) for _ in range(400)]
    assert _derive(spark, seed, points, 1 / 64) == _expected(seed, points)
    assert _derive(spark, seed, points, 1 / 64, budget=0, rows_per_task=30) == _expected(seed, points)


def test_no_join_of_the_index_is_left_to_file_sizes(spark, monkeypatch):
    """Every join says how it is done: by the measured size of a side, never by that of the file a side is computed from."""
    plans = []
    for owner, name in [(rg, "materialize"), (rg, "materialize_measured"), (rg, "materialize_observed")]:
        def write(df, *args, _real=getattr(owner, name), **metrics):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return _real(df, *args, **metrics)

        monkeypatch.setattr(owner, name, write)
    rng = random.Random(5)
    seed = spark.createDataFrame(_random_seed(rng, 40, *WORLDS["city"][0]), SEED)
    df = spark.createDataFrame([(str(i), rng.uniform(-74.6, -73.4), rng.uniform(40.2, 41.2)) for i in range(300)], "id string, lon double, lat double")
    x, y = rg.point(F.col("lon"), F.col("lat"))
    index = rg.index_regions(rg.occupied_cells(df, x, y), rg.parse_regions(seed))
    plans.append(rg.with_region(df, index, "id", x, y, F.lit(True))._jdf.queryExecution().optimizedPlan().toString())
    plans.append(rg.candidate_regions(index.cells, rg.parse_regions(seed))._jdf.queryExecution().optimizedPlan().toString())
    joins = [line for plan in plans for line in plan.split("\n") if "Join " in line]
    assert len(joins) > 10 and [line for line in joins if "strategy=" not in line] == []
