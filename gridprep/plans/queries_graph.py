"""Queries of rivers, proximity and dams (R, J07, J09, J14, J15, A18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridprep.operators import graph
from gridprep.plans.registry import query
from gridprep.plans.views import oracle, view

_WALK = "w AS (SELECT cell, cell AS loc, CAST(0 AS BIGINT) AS steps, area FROM v_river UNION ALL SELECT w.cell, r.next_cell, w.steps + 1, w.area FROM w JOIN v_river r ON r.cell = w.loc WHERE r.next_cell >= 0)"
_DIST = "2 * 6371000.785e0 * asin(sqrt(least(1, power(sin(radians({d} - {b}) / 2), 2) + cos(radians({b})) * cos(radians({d})) * power(sin(radians({c} - {a}) / 2), 2))))"


def _hav(a: str, b: str, c: str, d: str) -> str:
    return _DIST.format(a=a, b=b, c=c, d=d)


def _river(spark, sf):
    return graph.river_graph(view(spark, sf, "v_river"))


@query("r01_river_graph", oracle("v_river", "SELECT cell, CASE WHEN next_cell >= 0 THEN next_cell END AS next_cell FROM v_river"))
def r01(spark, sf):
    return _river(spark, sf)


_BAD = "b AS (SELECT cell, CASE WHEN cell % 41 = 7 THEN cell WHEN cell % 53 = 5 THEN cell + 10000000 WHEN cell % 61 = 50 THEN cell + 1 ELSE next_cell END AS next_cell FROM v_river)"
# as many steps as there are cells: who still goes on, never ends
_LOST = ", s AS (SELECT cell, next_cell AS loc, CAST(1 AS BIGINT) AS steps, cell <> next_cell AS ok FROM b UNION ALL SELECT s.cell, b.next_cell, s.steps + 1, b.cell <> b.next_cell FROM s JOIN b ON b.cell = s.loc WHERE s.ok AND s.loc >= 0 AND b.next_cell >= 0 AND s.steps <= 600)"


@query("r01_check_river", oracle("v_river", "SELECT DISTINCT cell, 'outside' AS problem FROM b WHERE next_cell >= 0 AND next_cell NOT IN (SELECT cell FROM v_river) UNION SELECT cell, 'itself' FROM b WHERE next_cell = cell UNION SELECT cell, 'cycle' FROM s WHERE steps > 600", _BAD + _LOST))
def r01_check(spark, sf):
    r = view(spark, sf, "v_river")
    bad = F.when(F.col("cell") % 41 == 7, F.col("cell")).when(F.col("cell") % 53 == 5, F.col("cell") + 10_000_000).when(F.col("cell") % 61 == 50, F.col("cell") + 1).otherwise(F.col("next_cell"))
    return graph.check_river(r.select("cell", bad.alias("next_cell")))


@query("r02_outlets", oracle("v_river", "SELECT cell, loc AS outlet, steps AS depth FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY steps DESC) AS r FROM w) WHERE r = 1", _WALK))
def r02(spark, sf):
    return graph.outlets(_river(spark, sf))


_LABELS = _WALK + ", p AS (SELECT cell, max(steps) AS depth FROM w GROUP BY 1), o AS (SELECT w.cell, w.loc AS outlet, p.depth FROM w JOIN p ON p.cell = w.cell AND w.steps = p.depth), u AS (SELECT loc AS cell, count(*) AS upstream FROM w GROUP BY 1), e AS (SELECT w.loc AS cell, 1 + coalesce((SELECT sum(u.upstream) FROM v_river s JOIN u ON u.cell = s.cell WHERE s.next_cell = r.next_cell AND s.cell < r.cell), 0) AS step FROM (SELECT DISTINCT loc FROM w) w JOIN v_river r ON r.cell = w.loc AND r.next_cell >= 0), q AS (SELECT w.cell, CAST(coalesce(sum(e.step), 0) AS BIGINT) AS pre FROM w LEFT JOIN e ON e.cell = w.loc GROUP BY 1)"


@query("r03_tree_labels", oracle("v_river", "SELECT cell, outlet, depth, pre, upstream FROM o JOIN u USING (cell) JOIN q USING (cell)", _LABELS))
def r03_labels(spark, sf):
    return graph.tree_labels(_river(spark, sf)).select("cell", "outlet", "depth", "pre", "upstream")


@query("r03_closure", oracle("v_river", "SELECT cell, loc AS down_cell, steps FROM w WHERE steps > 0", _WALK))
def r03(spark, sf):
    return graph.closure(_river(spark, sf))


@query("r04_accumulate", oracle("v_river", "SELECT loc AS cell, round(sum(area), 2) AS area FROM w GROUP BY 1", _WALK))
def r04(spark, sf):
    return graph.accumulate(_river(spark, sf), view(spark, sf, "v_river")).select("cell", F.round("area", 2).alias("area"))


_RADIUS = "n AS (SELECT a.cell, b.cell AS other, " + _hav("a.lon", "a.lat", "b.lon", "b.lat") + " AS distance FROM v_grid a JOIN v_grid b ON abs(a.grow - b.grow) <= 2)"


@query("j07_radius_join", oracle("v_grid", "SELECT cell, other, round(distance, 2) AS distance FROM n WHERE distance <= 75000", _RADIUS))
def j07(spark, sf):
    g = view(spark, sf, "v_grid")
    return graph.radius_join(g, g.withColumnRenamed("cell", "other"), 75_000.0).select("cell", "other", F.round("distance", 2).alias("distance"))


_FREE = _RADIUS + ", " + _WALK + ", f AS (SELECT cell, other, distance FROM n WHERE distance <= 75000 AND cell <> other AND NOT EXISTS (SELECT 1 FROM w WHERE w.cell = n.cell AND w.loc = n.other) AND NOT EXISTS (SELECT 1 FROM w WHERE w.cell = n.other AND w.loc = n.cell))"


def _pairs(spark, sf, labels):
    """The cells, and their pairs with the labels of both."""
    g = view(spark, sf, "v_grid")
    left, right = (graph.labelled(df, labels, [c]) for df, c in ((g, "cell"), (g.withColumnRenamed("cell", "other"), "other")))
    return g, graph.radius_join(left, right, 75_000.0, left_more=["__cell"], right_more=["__other"]).filter("cell <> other")


@query("j09_exclude_related", oracle("v_grid v_river", "SELECT cell, other FROM f", _FREE))
def j09(spark, sf):
    river = _river(spark, sf)
    labels = graph.tree_labels(river)
    return graph.unrelated(_pairs(spark, sf, labels)[1], river, labels=labels).select("cell", "other")


@query("r05_best_neighbour", oracle("v_grid v_river", "SELECT g.cell, coalesce(best, g.cell) AS best FROM v_grid g LEFT JOIN (SELECT f.cell, f.other AS best, row_number() OVER (PARTITION BY f.cell ORDER BY up / power(distance, 2) DESC, distance, f.other) AS r FROM f JOIN u ON u.loc = f.other) b ON b.cell = g.cell AND r = 1", _FREE + ", u AS (SELECT loc, sum(area) AS up FROM w GROUP BY 1)"))
def r05(spark, sf):
    river = _river(spark, sf)
    labels = graph.tree_labels(river, values=view(spark, sf, "v_river").select("cell", F.col("area").alias("value")))
    g, pairs = _pairs(spark, sf, labels)
    return graph.best_neighbour(g, river, None, pairs, labels=labels)


_SNAP = _WALK + ", u AS (SELECT loc AS cell, sum(area) AS up FROM w GROUP BY 1), c AS (SELECT point_id, g.cell, " + _hav("p.lon", "p.lat", "g.lon", "g.lat") + """ AS distance, (up - catch_area) / nullif(catch_area, 0) AS deviation FROM v_points p
   JOIN v_grid g ON abs(p.lat - g.lat) <= 1.0 AND least(abs(p.lon - g.lon), 360 - abs(p.lon - g.lon)) <= 1.0 JOIN u ON u.cell = g.cell),
   s AS (SELECT set_id, point_id, cell, distance, deviation, row_number() OVER (PARTITION BY set_id, point_id ORDER BY round(d * CASE WHEN distance > 0 THEN ln(distance) ELSE -1e9 END + CASE WHEN deviation > 0 THEN e * over_ ELSE e END * CASE WHEN abs(deviation) > 0 THEN ln(abs(deviation)) ELSE -1e9 END, 9), distance, cell) AS r
   FROM c CROSS JOIN (VALUES (1, 1.0, 1.0, 1.0), (2, 2.0, 0.5, 2.0)) v(set_id, d, e, over_) WHERE distance <= 100000 AND point_id % 10 <> 3)"""


@query("r06_snap_points", oracle("v_grid v_river v_points", "SELECT CAST(set_id AS INT) AS set_id, point_id, cell, round(distance, 2) AS distance, round(deviation, 6) AS deviation FROM s WHERE r = 1 UNION ALL SELECT CAST(set_id AS INT), p.point_id, g.cell, round(" + _hav("p.lon", "p.lat", "g.lon", "g.lat") + ", 2), round((up - catch_area) / nullif(catch_area, 0), 6) FROM v_points p JOIN v_grid g ON g.cell = p.point_id JOIN u ON u.cell = g.cell CROSS JOIN (VALUES (1), (2)) v(set_id) WHERE p.point_id % 10 = 3", _SNAP))
def r06(spark, sf):
    grid = view(spark, sf, "v_grid").join(graph.accumulate(_river(spark, sf), view(spark, sf, "v_river")), "cell")
    params = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, 2.0, 0.5, 2.0)], "set_id int, d double, e double, over double")
    points = view(spark, sf, "v_points")
    manual = points.filter("point_id % 10 = 3").select("point_id", F.col("point_id").alias("cell"))
    return graph.snap_points(points, grid, params, 1.0, 100_000.0, manual).select("set_id", "point_id", "cell", F.round("distance", 2).alias("distance"), F.round("deviation", 6).alias("deviation"))


_STEP = "d AS (SELECT cell, gcol, grow, lon, lat, CASE cell % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN 0 END AS dc, CASE cell % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS dr FROM v_grid)"


@query("r07_directions", oracle("v_grid", "SELECT d.cell, CASE WHEN g.cell <> d.cell THEN g.cell END AS next_cell, round(CASE WHEN g.cell <> d.cell THEN " + _hav("d.lon", "d.lat", "g.lon", "g.lat") + " END, 2) AS distance FROM d LEFT JOIN v_grid g ON g.gcol = d.gcol + d.dc AND g.grow = d.grow + d.dr", _STEP))
def r07(spark, sf):
    g = view(spark, sf, "v_grid")
    codes = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, -1, 1), (3, 0, 0)], "code int, dcol int, drow int")
    return graph.directions_to_graph(g.select("gcol", "grow", (F.col("cell") % 5).cast("int").alias("code")), codes, g, 50).select("cell", "next_cell", F.round("distance", 2).alias("distance"))


_DAMS = "d AS (SELECT point_id % 12 AS cell, point_id AS dam_id, capacity, catch_area AS area, point_id % 17 AS height, year, CAST(point_id % 3 + 1 AS INT) AS purpose, point_id % 5 = 0 AS irrigation FROM v_points)"


@query(
    "a18_merge_dams",
    oracle("v_points", """SELECT f.cell, round(capacity, 2) AS capacity, round(area, 2) AS area, height, irrigation, n, purpose, year FROM
     (SELECT cell, sum(capacity) AS capacity, sum(area) AS area, arg_min(height, struct_pack(a := -capacity, b := dam_id)) AS height, bool_or(irrigation) AS irrigation, count(*) AS n FROM d GROUP BY 1) f
     JOIN (SELECT cell, purpose FROM (SELECT cell, purpose, row_number() OVER (PARTITION BY cell ORDER BY sum(capacity) DESC, purpose) AS r FROM d GROUP BY 1, 2) WHERE r = 1) p USING (cell)
     LEFT JOIN (SELECT cell, min(year) AS year FROM (SELECT cell, year, sum(capacity) OVER (PARTITION BY cell ORDER BY year) AS upto, sum(capacity) OVER (PARTITION BY cell) AS tot FROM d WHERE year IS NOT NULL) WHERE upto >= tot / 2 GROUP BY 1) y USING (cell)""", _DAMS),
)
def a18(spark, sf):
    p = view(spark, sf, "v_points")
    d = p.select((F.col("point_id") % 12).alias("cell"), F.col("point_id").alias("dam_id"), "capacity", F.col("catch_area").alias("area"), (F.col("point_id") % 17).alias("height"), "year", (F.col("point_id") % 3 + 1).cast("int").alias("purpose"), (F.col("point_id") % 5 == 0).alias("irrigation"))
    out = graph.merge_dams(d)
    return out.select("cell", F.round("capacity", 2).alias("capacity"), F.round("area", 2).alias("area"), "height", "irrigation", "n", "purpose", "year")
