"""Point in polygon, street interpolation and map grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.functions.rules import GRID_BOX
from urbanspark.operators.tables import broadcast_within


def _edges(polygons: DataFrame) -> DataFrame:
    ring = Window.partitionBy("region", "part").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return polygons.select(
        "region_no",
        "region",
        F.col("x").alias("x1"),
        F.col("y").alias("y1"),
        F.coalesce(F.lead("x").over(ring), F.first("x").over(whole)).alias("x2"),
        F.coalesce(F.lead("y").over(ring), F.first("y").over(whole)).alias("y2"),
    )


def assign_region(
    points: DataFrame, polygons: DataFrame, lon: str, lat: str, output: str = "region", bands: int = 256
) -> DataFrame:
    """Add the region whose polygon contains the point, null if none.

    ``polygons`` has one row per corner: region_no, region, part, seq, x, y; parts of a region are closed
    rings and count together, so a hole is a ring inside another. A point that lies in two regions
    gets the one with the higher number.

    The map is cut into horizontal bands. Each band holds, per region, only the edges that reach into
    it, so a point meets one row of the band table (a hash join on the band) and tests the edges
    there in place: an odd number of edges to its right means inside. Points are neither multiplied
    nor shuffled. Points exactly on an edge are not defined.
    """
    # One row of bounds decides the bands and proves the size of the band table.
    ymin, ymax, corners = polygons.agg(F.min("y"), F.max("y"), F.count("*")).first()
    height = (ymax - ymin) / bands or 1.0

    def band(y: Column) -> Column:
        return F.floor((y - F.lit(ymin)) / F.lit(height))

    edge = F.struct("x1", "y1", "x2", "y2")
    by_region = (
        _edges(polygons)
        .filter("y1 <> y2")
        .withColumn("__band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
        .groupBy("__band", "region_no", "region")
        .agg(F.collect_list(edge).alias("edges"))
    )
    table = by_region.groupBy("__band").agg(
        F.array_sort(F.collect_list(F.struct("region_no", "region", "edges"))).alias("__regions")
    )

    x, y = F.col(lon), F.col(lat)

    def crosses(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)

    def contains(region: Column) -> Column:
        return F.size(F.filter(region["edges"], crosses)) % 2 == 1

    inside = F.filter("__regions", contains)
    # An edge is at most repeated once per band; the bound is on all copies.
    joined = points.withColumn("__band", band(y)).join(broadcast_within(table, corners * bands), "__band", "left")
    return joined.withColumn(output, F.get(inside, F.size(inside) - 1)["region"]).drop("__band", "__regions")


def assign_region_exactly(
    points: DataFrame, polygons: DataFrame, lon: str, lat: str, digits: int = 7, bands: int = 256
) -> DataFrame:
    """Add ``region``, whose polygon holds the point inside its edges, and ``edge_of``, on whose edge or corner it lies.

    Coordinates are rounded to ``digits`` decimals and scaled to whole numbers, so the side of an edge is an exact
    sign and a point on an edge is never inside. Of several regions the one with the highest number counts, for
    each column by itself; null if there is none or a coordinate is null. ``polygons`` and bands are as in ``assign_region``.
    """

    def whole(c: str) -> Column:
        return F.round(F.col(c) * F.lit(10.0**digits)).cast("bigint")

    scaled = polygons.withColumns({"x": whole("x"), "y": whole("y")})
    ymin, ymax, corners = scaled.agg(F.min("y"), F.max("y"), F.count("*")).first()
    height = ((ymax or 0) - (ymin or 0)) // bands + 1

    def band(y: Column) -> Column:
        return F.floor((y - F.lit(ymin or 0)) / F.lit(height))

    # Flat edges decide no crossing, but points may lie on them.
    table = (
        _edges(scaled)
        .withColumn("__band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
        .groupBy("__band", "region_no", "region")
        .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
        .groupBy("__band")
        .agg(F.array_sort(F.collect_list(F.struct("region_no", "region", "edges"))).alias("__regions"))
    )
    x, y = F.col("__x"), F.col("__y")

    def turn(e: Column) -> Column:
        """Sign of the side of the edge on which the point lies; products may pass 64 bits."""
        exact = lambda a, b: a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
        left, right = exact(e["x2"] - e["x1"], y - e["y1"]), exact(e["y2"] - e["y1"], x - e["x1"])
        return F.when(left > right, 1).when(left < right, -1).otherwise(0)

    def touches(e: Column) -> Column:
        near = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return near & (turn(e) == 0)

    def crosses(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & ((turn(e) > 0) == (e["y2"] > e["y1"]))

    on_edge = F.filter("__regions", lambda r: F.exists(r["edges"], touches))
    inside = F.filter("__regions", lambda r: ~F.exists(r["edges"], touches) & (F.size(F.filter(r["edges"], crosses)) % 2 == 1))
    placed = points.withColumns({"__x": whole(lon), "__y": whole(lat)}).withColumn("__band", band(y))
    joined = placed.join(broadcast_within(table, corners * bands), "__band", "left")
    last = lambda found: F.get(found, F.size(found) - 1)["region"]
    return joined.withColumns({"region": last(inside), "edge_of": last(on_edge)}).drop("__band", "__regions", "__x", "__y")


def interpolate_house(number: Column, low: Column, high: Column, first: Column, last: Column) -> Column:
    """Coordinate of a house number between the two ends of its street.

    Number 0 (unreadable) is the midpoint. The fraction runs from the high end, as in the rule
    reproduced: the highest number maps to ``first``, the lowest to ``last``. Equal ends give null.
    """
    fraction = (number - high) / F.nullif(low - high, F.lit(0))
    return F.when(number == 0, (first + last) / 2).otherwise(first + fraction * (last - first))


def grid_cell(lat: Column, lon: Column, box: dict = GRID_BOX) -> tuple[Column, Column]:
    """Cell numbers (x, y) in the map grid, cut towards zero."""
    x = (lon - box["xmin"]) / (box["xmax"] - box["xmin"]) * box["cells"]
    y = (lat - box["ymin"]) / (box["ymax"] - box["ymin"]) * box["cells"]
    return x.cast("int"), y.cast("int")
