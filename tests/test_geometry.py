import math

import pytest
from brute import contains as slow_contains
from brute import distance as slow_distance
from brute import edges_of
from pyspark.sql import functions as F

from recordloom.functions import geometry as g

HOLED = (
    "POLYGON((-74.5 40, -74 40, -74 40.5, -74.5 40.5, -74.5 40),"
    "(-74.4 40.1, -74.3 40.1, -74.3 40.2, -74.4 40.2, -74.4 40.1))"
)
MULTI = (
    "MULTIPOLYGON(((-74 40, -73.5 40, -73.5 40.5, -74 40.5, -74 40)),((-73.9 40.6, -73.6 40.6, -73.75 40.9, -73.9 40.6)))"
)
PLAIN = "POLYGON((-74.5 40.7, -74.2 40.7, -74.2 41, -74.5 41, -74.5 40.7))"
REVERSED = "POLYGON ((-74.5 40.7,-74.5 41,-74.2 41,-74.2 40.7,-74.5 40.7))"
SHAPES = [HOLED, MULTI, PLAIN, REVERSED]


def test_edges(spark):
    df = spark.createDataFrame([(w,) for w in SHAPES], "w string")
    rows = df.select("w", g.wkt_edges(F.col("w")).alias("e")).collect()
    for r in rows:
        assert [tuple(e) for e in r.e] == edges_of(r.w)
    assert sum(len(r.e) for r in rows[:3]) == 19


@pytest.mark.parametrize("text", ["POLYGON EMPTY", "", None])
def test_no_edges(spark, text):
    got = spark.createDataFrame([(text,)], "w string").select(g.wkt_edges(F.col("w"))).collect()[0][0]
    assert not got


def test_containment_and_distance_on_a_lattice(spark):
    points = [(-74.6 + i * 0.05, 39.9 + j * 0.05) for i in range(27) for j in range(27)]
    exact = [(-74.5, 40.25), (-74.0, 40.25), (-74.25, 40.5), (-74.4, 40.15), (-74.5, 40.0), (-74.35, 40.15), (-74.2, 41.0)]
    shapes = spark.createDataFrame([(w,) for w in SHAPES], "w string").withColumn("e", g.wkt_edges(F.col("w")))
    spots = spark.createDataFrame(points + exact, "x double, y double")
    rows = spots.crossJoin(shapes).select(
        "x", "y", "w",
        g.contains(F.col("e"), F.col("x"), F.col("y")).alias("inside"),
        g.distance(g.segments(F.col("e")), F.col("x"), F.col("y"), g.shrink(F.col("y"))).alias("far"),
    ).collect()
    assert any(r.inside for r in rows)
    for r in rows:
        edges = edges_of(r.w)
        assert r.inside == slow_contains(edges, r.x, r.y), r
        assert math.isclose(r.far, slow_distance(edges, r.x, r.y), abs_tol=2e-9), r


def test_boundary_is_outside_at_distance_zero(spark):
    df = spark.createDataFrame([(-74.5, 40.25), (-74.25, 40.0), (-74.5, 40.0), (-74.4, 40.15)], "x double, y double")
    df = df.withColumn("e", g.wkt_edges(F.lit(HOLED)))
    x, y = F.col("x"), F.col("y")
    for r in df.select(g.contains(F.col("e"), x, y), g.distance(g.segments(F.col("e")), x, y, g.shrink(y))).collect():
        assert tuple(r) == (False, 0.0)


def test_degenerate_edge(spark):
    df = spark.range(1).select(g.wkt_edges(F.lit("POLYGON((0 0, 0 0, 1 0, 1 1, 0 0))")).alias("e"))
    far = df.select(g.distance(g.segments(F.col("e")), F.lit(-3.0), F.lit(0.0), F.lit(1.0))).collect()[0][0]
    assert far == 3.0


def test_texts_that_are_no_polygon_are_told(spark):
    bad = {
        "POLYGON((0 0, 1 0, 1 1, 0 0)": "not the text", "LINESTRING(0 0, 1 1)": "not the text", "": "not the text",
        "POLYGON((0 0, 1 0, x 1, 0 0))": "not the text", "POLYGON((0 0, 1 0, 1 1, 0 1))": "not closed",
        "POLYGON((0 0, 1 0, 0 0))": "not closed", "POLYGON((0 0 5, 1 0 5, 1 1 5, 0 0 5))": "not the text",
        "POLYGON((0 0, 1 0, 1 1, 0 0)) x": "not the text", "MULTIPOLYGON((0 0, 1 0, 1 1, 0 0))": "not the text",
    }
    ring = ", ".join(f"{i}.5 -{i}e0" for i in range(20_000))
    good = [*SHAPES, None, "POLYGON EMPTY", "multipolygon empty", f"POLYGON (({ring}, 0.5 0))"]
    df = spark.createDataFrame([(w,) for w in [*bad, *good]], "w string")
    got = [r[0] for r in df.select(g.wkt_problem(F.col("w"))).collect()]
    for text, expected in zip([*bad.values(), *[None] * len(good)], got):
        assert expected is None if text is None else text in expected
