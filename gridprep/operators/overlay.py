"""Areas of polygons in grid cells. Edges are straight in longitude and latitude, areas are on the sphere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.functions.geo import EARTH_RADIUS, GridSpec

#: Areas below this (m2) are rounding.
NOTHING = 1e-3


def ring_sign(points: Column | str = "points") -> Column:
    """1 for a ring of points (lon, lat) that runs clockwise, -1 for one that runs the other way."""
    points = F.col(points) if isinstance(points, str) else points
    following = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    cross = F.zip_with(points, following, lambda p, q: p["lon"].cast("double") * q["lat"] - q["lon"].cast("double") * p["lat"])
    return -F.signum(F.aggregate(cross, F.lit(0.0), lambda a, x: a + x))


def polygon_cell_area(polygons: DataFrame, spec: GridSpec) -> DataFrame:
    """code, gcol, grow, area: the polygons' area in each cell of the lattice, summed over pieces of the same code.

    ``polygons``: poly_id, part, ring (0: outer, others: holes), code, points ARRAY<STRUCT<lon,lat>>. Rings don't cross
    themselves; those of less than three points, and pieces without area, go.

    The area below an edge of a ring, added up along the ring, is the area inside. So each edge goes to the columns it
    crosses, and its part in a column to the rows it crosses: there it gives the area below it inside the cell, and its
    width to all cells further south, which a running sum over a column's rows adds up. Work grows with the edges and
    the cells they cross, and inner cells cost a row each; no ring is ever copied.
    """
    west, north, dx, dy = (F.lit(float(v)) for v in (spec.xmin, spec.ymax, spec.res_lon, spec.res_lat))
    rings = polygons.filter(F.size("points") >= 3).withColumn("sign", ring_sign() * F.when(F.col("ring") == 0, 1.0).otherwise(-1.0))
    following = F.concat(F.slice("points", 2, F.size("points")), F.slice("points", 1, 1))
    edge = F.zip_with("points", following, lambda p, q: F.struct(p["lon"].cast("double").alias("x1"), p["lat"].cast("double").alias("y1"), q["lon"].cast("double").alias("x2"), q["lat"].cast("double").alias("y2")))
    edges = rings.select("code", "sign", F.explode(edge).alias("e")).select("code", "sign", "e.*").filter("x1 <> x2")
    # an edge's part in each column it crosses
    first = F.greatest(F.floor((F.least("x1", "x2") - west) / dx), F.lit(0))
    last = F.least(F.ceil((F.greatest("x1", "x2") - west) / dx) - 1, F.lit(spec.ncol - 1))
    parts = edges.withColumn("c0", first.cast("int")).withColumn("c1", last.cast("int")).filter("c0 <= c1").withColumn("gcol", F.explode(F.sequence("c0", "c1")))
    left, right = west + F.col("gcol") * dx, west + (F.col("gcol") + 1) * dx
    within = lambda x, low, high: F.least(F.greatest(x, low), high)
    parts = parts.withColumn("xa", within(F.col("x1"), left, right)).withColumn("xb", within(F.col("x2"), left, right)).filter("xa <> xb")
    lat = lambda x: F.col("y1") + (F.col("y2") - F.col("y1")) * ((x - F.col("x1")) / (F.col("x2") - F.col("x1")))
    parts = parts.withColumn("ya", lat(F.col("xa"))).withColumn("yb", lat(F.col("xb")))
    # and in each row; row -1 stands for all that is north of the lattice
    row = lambda y: F.floor((north - y) / dy)
    top, bottom = F.greatest(row(F.greatest("ya", "yb")), F.lit(-1)), F.least(row(F.least("ya", "yb")), F.lit(spec.nrow - 1))
    parts = parts.withColumn("r0", top.cast("int")).withColumn("r1", F.greatest(bottom, F.lit(-1)).cast("int")).filter("r0 <= r1 and r0 < %d" % spec.nrow)
    parts = parts.withColumn("grow", F.explode(F.sequence("r0", "r1")))
    south = north - (F.col("grow") + 1) * dy
    upper = F.when(F.col("grow") < 0, F.lit(1e9)).otherwise(north - F.col("grow") * dy)
    slope = F.when(F.col("yb") != F.col("ya"), (F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya")))
    parts = parts.withColumn("ys", within(F.col("ya"), south, upper)).withColumn("yt", within(F.col("yb"), south, upper))
    width = F.radians(F.coalesce((F.col("yt") - F.col("ys")) * slope, F.col("xb") - F.col("xa"))) * F.col("sign")
    s, t = F.radians("ys"), F.radians("yt")
    # the mean of sin(latitude) along the part
    mean = F.when(F.abs(t - s) < 1e-9, F.sin((s + t) / 2)).otherwise((F.cos(s) - F.cos(t)) / (t - s))
    own = F.when(F.col("grow") < 0, F.lit(0.0)).otherwise(width * (mean - F.sin(F.radians(south))))
    cells = parts.groupBy("code", "gcol", "grow").agg(F.sum(own).alias("own"), F.sum(width).alias("width"))
    rows = Window.partitionBy("code", "gcol").orderBy("grow")
    cells = cells.withColumn("above", F.coalesce(F.sum("width").over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    cells = cells.withColumn("next", F.coalesce(F.lead("grow").over(rows), F.lit(spec.nrow)))
    # cells between two rows with edges lie inside as far as the edges above them leave a width
    inner = F.when((F.col("next") > F.col("grow") + 1) & (F.abs(F.col("above") + F.col("width")) > 1e-12), F.sequence(F.col("grow") + 1, F.col("next") - 1))
    cells = cells.withColumn("at", F.explode(F.concat(F.array("grow"), F.coalesce(inner, F.array().cast("array<int>"))))).filter("at >= 0")
    band = F.sin(F.radians(north - F.col("at") * dy)) - F.sin(F.radians(north - (F.col("at") + 1) * dy))
    inside = F.when(F.col("at") == F.col("grow"), F.col("own") + F.col("above") * band).otherwise((F.col("above") + F.col("width")) * band)
    return cells.select("code", "gcol", F.col("at").alias("grow"), (inside * F.lit(EARTH_RADIUS**2)).alias("area")).filter(F.col("area") > NOTHING)


def union_layers(a: DataFrame, b: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both layers as one, and the requested classes that neither has."""
    both = a.unionByName(b)
    return both, classes.join(both.select("type").distinct(), "type", "left_anti")


def select_admin_shapes(l0: DataFrame, l1: DataFrame, include: DataFrame, skip: DataFrame) -> DataFrame:
    """Level-1 shapes of the included countries that have any, level-0 shapes of all others; skipped countries go."""
    finer = l1.join(include, "country", "left_semi").join(skip, "country", "left_anti")
    whole = l0.join(skip, "country", "left_anti").join(finer.select("country").distinct(), "country", "left_anti")
    return finer.select("country", "shape", F.lit(1).alias("level")).unionByName(whole.select("country", "shape", F.lit(0).alias("level")))


def choose_source(candidates: DataFrame, target: GridSpec, crops: int) -> DataFrame:
    """The coarsest of the data sets that have all crops, a resolution dividing the target's, its extent and a convertible unit.

    ``candidates``: dataset, crop, res, xmin, xmax, ymin, ymax, convertible; one row for each file.
    """
    one = candidates.groupBy("dataset").agg(F.count_distinct("crop").alias("n"), F.max("res").alias("res"), F.max("xmin").alias("xmin"), F.min("xmax").alias("xmax"), F.max("ymin").alias("ymin"), F.min("ymax").alias("ymax"), F.bool_and("convertible").alias("ok"))
    ratio = F.lit(target.res_lon) / F.col("res")
    valid = one.filter(F.col("ok") & (F.col("n") >= crops) & (F.abs(ratio - F.round(ratio)) < 1e-4) & (ratio >= 1 - 1e-4) & (F.col("xmin") <= target.xmin + 1e-9) & (F.col("xmax") >= target.xmax - 1e-9) & (F.col("ymin") <= target.ymin + 1e-9) & (F.col("ymax") >= target.ymax - 1e-9))
    return valid.orderBy(F.desc("res"), "dataset").limit(1).select("dataset", "res")
