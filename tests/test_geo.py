import random

from pyspark.sql import functions as F

from checks import views as V
from tests.conftest import plan_of
from urbanspark.operators import geo
from urbanspark.operators.tables import inline_table

POLYGON = "region_no int, region string, part int, seq int, x double, y double"


def ring(no, name, part, corners):
    return [(no, name, part, i, float(x), float(y)) for i, (x, y) in enumerate(corners)]


def located(spark, polygons, points, **settings):
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    table = spark.createDataFrame(polygons, POLYGON)
    return {r["i"]: r["region"] for r in geo.assign_region(df, table, "lon", "lat", **settings).collect()}


def inside(corners, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def test_random_polygon(spark):
    rng = random.Random(5)
    corners = [(rng.random() * 10, rng.random() * 10) for _ in range(30)]  # crosses itself: parity still defines it
    points = [(i, rng.uniform(-1, 11), rng.uniform(-1, 11)) for i in range(500)]
    expected = {i: "p" if inside(corners, x, y) else None for i, x, y in points}
    for bands in (1, 7, 256):
        assert located(spark, ring(1, "p", 0, corners), points, bands=bands) == expected


def test_holes_parts_and_overlap(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    polygons = ring(1, "outer", 0, square(0, 10)) + ring(1, "outer", 1, square(2, 4)) + ring(2, "upper", 0, square(8, 12))
    points = [(0, 1.0, 1.0), (1, 3.0, 3.0), (2, 9.0, 9.0), (3, 11.0, 11.0), (4, 20.0, 20.0), (5, None, 1.0)]
    assert located(spark, polygons, points) == {0: "outer", 1: None, 2: "upper", 3: "upper", 4: None, 5: None}


def test_edges_and_corners_are_not_inside(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    polygons = spark.createDataFrame(ring(1, "low", 0, square(0.1, 0.7)) + ring(2, "high", 0, square(0.7, 1.3)), POLYGON)
    points = [(0, 0.3, 0.3), (1, 0.7, 0.3), (2, 0.7, 0.7), (3, 0.1, 0.1), (4, 0.9, 1.3), (5, 0.9, 0.9), (6, 2.0, 0.3), (7, None, 0.3), (8, 0.7000001, 0.9)]
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    wanted = {0: ("low", None), 1: (None, "low"), 2: (None, "high"), 3: (None, "low"), 4: (None, "high"), 5: ("high", None)}
    wanted |= {6: (None, None), 7: (None, None), 8: ("high", None)}
    for bands in (1, 7, 256):
        rows = geo.assign_region_exactly(df, polygons, "lon", "lat", bands=bands).collect()
        assert {r["i"]: (r["region"], r["edge_of"]) for r in rows} == wanted


def test_points_are_not_multiplied(spark):
    points = spark.range(1000).select(F.col("id").alias("i"), (F.rand(1) * 10).alias("lon"), (F.rand(2) * 10).alias("lat"))
    df = geo.assign_region(points, V.polygons(spark), "lon", "lat")
    plan = plan_of(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
    assert df.count() == 1000


def test_interpolation(spark):
    df = inline_table(spark, ["no"], [(0,), (10,), (30,), (20,)])
    lat = geo.interpolate_house(F.col("no"), F.lit(10), F.lit(30), F.lit(1.0), F.lit(3.0))
    assert [r[0] for r in df.select(lat).collect()] == [2.0, 3.0, 1.0, 2.0]
    same = geo.interpolate_house(F.col("no"), F.lit(10), F.lit(10), F.lit(1.0), F.lit(3.0))
    assert [r[0] for r in df.select(same).collect()] == [2.0, None, None, None]


def test_grid(spark):
    x, y = geo.grid_cell(F.lit(40.7), F.lit(-73.975))
    assert tuple(spark.range(1).select(x, y).first()) == (499, 500) or tuple(spark.range(1).select(x, y).first()) == (500, 500)
