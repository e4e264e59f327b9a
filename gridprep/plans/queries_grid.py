"""Queries of grid algebra and joins on cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridprep.functions.geo import GridSpec
from gridprep.operators import grid
from gridprep.plans.registry import query
from gridprep.plans.views import oracle, table, view

SPEC = GridSpec(167.5, 75.0, 0.5, 0.5, 50, 300)
_B = "CAST(floor(gcol / 2.0) AS INT) AS bcol, CAST(floor(grow / 4.0) AS INT) AS brow"


@query("a01_block_sum", oracle("v_raster", f"SELECT {_B}, round(sum(value), 4) AS value FROM v_raster GROUP BY ALL"))
def a01(spark, sf):
    return grid.block_agg(view(spark, sf, "v_raster"), 2, 4).select("bcol", "brow", F.round("value", 4).alias("value"))


@query("a01_block_mean_layers", oracle("v_raster", f"SELECT {_B}, class, round(avg(value), 4) AS value FROM v_raster GROUP BY ALL"))
def a01_mean(spark, sf):
    return grid.block_agg(view(spark, sf, "v_raster"), 2, 4, "mean", layers=["class"]).select("bcol", "brow", "class", F.round("value", 4).alias("value"))


def _mode(order: str) -> str:
    return oracle("v_raster", "SELECT bcol, brow, class FROM (SELECT *, row_number() OVER (PARTITION BY bcol, brow ORDER BY n DESC, " + order + ") AS r FROM m) WHERE r = 1", f"m AS (SELECT {_B.replace('2.0', '5.0')}, class, count(*) AS n, min(cell) AS loc FROM v_raster GROUP BY ALL)")


for _ties, _order in (("lowest", "class"), ("highest", "class DESC"), ("first", "loc")):

    @query(f"a02_mode_{_ties}", _mode(_order))
    def a02(spark, sf, ties=_ties):
        return grid.block_mode(view(spark, sf, "v_raster"), 5, 4, "class", ties)


@query("a03_block_median", oracle("v_raster", f"SELECT {_B}, round(median(value), 4) AS median, round(avg(value), 4) AS mean, count(value) AS n FROM v_raster GROUP BY ALL"))
def a03(spark, sf):
    return grid.block_median(view(spark, sf, "v_raster"), 2, 4).select("bcol", "brow", F.round("median", 4).alias("median"), F.round("mean", 4).alias("mean"), "n")


@query("a06_dominant", oracle("v_raster v_admin", "SELECT CAST(grow AS INT) AS grow, CAST(level0 AS INT) AS code, round(tot, 4) AS area FROM (SELECT grow, level0, sum(s) OVER (PARTITION BY grow) AS tot, row_number() OVER (PARTITION BY grow ORDER BY level0 IN (0, 1, 2), s DESC, level0) AS r FROM (SELECT grow, level0, sum(area) AS s FROM v_raster JOIN v_admin USING (cell) GROUP BY 1, 2)) WHERE r = 1"))
def a06(spark, sf):
    cells = view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell")
    return grid.dominant(cells, "grow", "level0", "area", [0, 1, 2]).select("grow", F.col("level0").alias("code"), F.round("area", 4).alias("area"))


_LEVELS = """b AS (SELECT grow, level0, level1, level2, area FROM v_raster JOIN v_admin USING (cell)),
  x0 AS (SELECT grow, level0 FROM (SELECT grow, level0, row_number() OVER (PARTITION BY grow ORDER BY sum(area) DESC, level0) AS r FROM b GROUP BY 1, 2) WHERE r = 1),
  x1 AS (SELECT grow, level1 FROM (SELECT grow, level1, row_number() OVER (PARTITION BY grow ORDER BY sum(area) DESC, level1) AS r FROM b JOIN x0 USING (grow, level0) GROUP BY 1, 2) WHERE r = 1),
  x2 AS (SELECT grow, level2 FROM (SELECT grow, level2, row_number() OVER (PARTITION BY grow ORDER BY sum(area) DESC, level2) AS r FROM b JOIN x0 USING (grow, level0) JOIN x1 USING (grow, level1) GROUP BY 1, 2) WHERE r = 1)"""


@query("a07_dominant_levels", oracle("v_raster v_admin", "SELECT grow, level0, level1, level2 FROM x0 JOIN x1 USING (grow) JOIN x2 USING (grow)", _LEVELS))
def a07(spark, sf):
    cells = view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell")
    return grid.dominant_levels(cells, "grow", ["level0", "level1", "level2"], "area")


@query("a08_count_distinct", oracle("v_raster v_admin", "SELECT grow, count(DISTINCT level0) AS n FROM v_raster JOIN v_admin USING (cell) GROUP BY 1"))
def a08(spark, sf):
    return grid.count_distinct(view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell"), "grow", "level0")


@query("a09_area_fraction", oracle("v_raster v_admin", "SELECT grow, round(least(1, sum(area * (cell % 4) / 4) / t), 6) AS fraction FROM v_raster JOIN v_admin USING (cell) JOIN (SELECT grow, sum(area) AS t FROM v_raster JOIN v_admin USING (cell) GROUP BY 1) USING (grow) GROUP BY grow, t"))
def a09(spark, sf):
    cells = view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell")
    total = cells.groupBy("grow").agg(F.sum("area").alias("total"))
    pieces = cells.select("grow", (F.col("area") * (F.col("cell") % 4) / 4).alias("piece")).join(total, "grow")
    return grid.area_fraction(pieces, "grow", "piece", "total").select("grow", F.round("fraction", 6).alias("fraction"))


@query("a10_class_fraction", oracle("v_raster v_admin", f"SELECT {_B}, round(sum(CASE WHEN class = 1 THEN area ELSE 0 END) / sum(area), 6) AS lakes, round(sum(CASE WHEN class = 3 THEN area ELSE 0 END) / sum(area), 6) AS rivers, round(sum(CASE WHEN class IN (1, 3) THEN area ELSE 0 END) / sum(area), 6) AS \"all\" FROM v_raster JOIN v_admin USING (cell) GROUP BY ALL"))
def a10(spark, sf):
    out = grid.class_fraction(view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell"), {"lakes": 1, "rivers": 3}, 2, 4)
    return out.select("bcol", "brow", *(F.round(c, 6).alias(c) for c in ("lakes", "rivers", "all")))


@query("a14_time_max", oracle("v_slices", "SELECT CAST(floor(cell / 10.0) AS BIGINT) AS block, round(sum(m), 2) AS value FROM (SELECT cell, max(value) AS m FROM v_slices GROUP BY 1) GROUP BY 1"))
def a14(spark, sf):
    m = grid.time_max(view(spark, sf, "v_slices"), ["cell"], "value")
    return m.groupBy(F.floor(F.col("cell") / 10).alias("block")).agg(F.round(F.sum("value"), 2).alias("value"))


@query("j01_extract", oracle("v_grid v_raster", "SELECT g.cell, coalesce(r.value, -1) AS value FROM v_grid g LEFT JOIN v_raster r ON r.gcol = g.gcol AND r.grow = g.grow"))
def j01(spark, sf):
    return grid.extract(view(spark, sf, "v_grid"), view(spark, sf, "v_raster"), default=-1.0).select("cell", "value")


_COARSE = f"c AS (SELECT {_B}, max(value) AS top FROM v_raster GROUP BY ALL)"


@query("j02_overlay", oracle("v_raster", "SELECT r.cell, top FROM v_raster r JOIN c ON c.bcol = floor(r.gcol / 2.0) AND c.brow = floor(r.grow / 4.0)", _COARSE))
def j02(spark, sf):
    r = view(spark, sf, "v_raster")
    coarse = grid.block_agg(r, 2, 4, "max").withColumnRenamed("value", "top")
    return grid.overlay(r, coarse, 2, 4).select("cell", "top")


_NEAR = "n AS (SELECT a.cell, b.cell AS other FROM v_grid a JOIN v_grid b ON abs(a.gcol - b.gcol) <= 1 AND abs(a.grow - b.grow) <= 1 AND a.cell <> b.cell)"


@query("j08_adjacent", oracle("v_grid", "SELECT cell, other FROM n", _NEAR))
def j08(spark, sf):
    return grid.adjacent(view(spark, sf, "v_grid"), 50)


@query("j10_conform", oracle("v_grid v_raster", "SELECT g.cell, coalesce(r.value, 0) AS value, coalesce(r.code, 'No land') AS code FROM v_grid g LEFT JOIN (SELECT cell, value, concat('C', CAST(class AS VARCHAR)) AS code FROM v_raster WHERE cell % 3 <> 0) r USING (cell)"))
def j10(spark, sf):
    r = view(spark, sf, "v_raster").filter("cell % 3 <> 0").select("cell", "value", F.concat(F.lit("C"), F.col("class").cast("string")).alias("code"))
    return grid.conform_to_grid(r, view(spark, sf, "v_grid"), defaults={"value": 0.0, "code": "No land"})[0]


@query("j10_dropped", oracle("v_grid v_raster", "SELECT count(*) AS n FROM v_raster WHERE cell NOT IN (SELECT cell FROM v_grid WHERE gcol < 40)"))
def j10_dropped(spark, sf):
    return grid.conform_to_grid(view(spark, sf, "v_raster"), view(spark, sf, "v_grid").filter("gcol < 40"))[1].agg(F.count(F.lit(1)).alias("n"))


_POINTS = "p AS (SELECT point_id AS cell, ((lon + 360 - 167.5e0) - 360 * floor((lon + 360 - 167.5e0) / 360)) / 0.5e0 - 0.5e0 AS x, (75 - lat) / 0.5e0 - 0.5e0 AS y FROM v_points)"
_BILINEAR = _POINTS + ", o AS (SELECT cell, CAST(floor(x) AS INT) + i AS c, CAST(floor(y) AS INT) + j AS r, greatest(1 - abs(x - floor(x) - i), 0) * greatest(1 - abs(y - floor(y) - j), 0) AS w FROM p CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j))"


def _unwrapped(spark, sf):
    """The points, with longitudes that grow to the east of the lattice's edge."""
    return view(spark, sf, "v_points").select(F.col("point_id").alias("cell"), (F.lit(167.5) + F.pmod(F.col("lon") + 360 - 167.5, F.lit(360.0))).alias("lon"), "lat")


@query("j17_bilinear", oracle("v_points v_raster", "SELECT p.cell, round(v, 4) AS value FROM p LEFT JOIN (SELECT o.cell, sum(w * value) / nullif(sum(w), 0) AS v FROM o JOIN v_raster r ON r.gcol = o.c AND r.grow = o.r WHERE value IS NOT NULL AND w <> 0 GROUP BY 1) USING (cell)", _BILINEAR))
def j17(spark, sf):
    return grid.regrid(view(spark, sf, "v_raster"), SPEC, _unwrapped(spark, sf)).select("cell", F.round("value", 4).alias("value"))


@query("j17_nearest_fill", oracle("v_points v_raster", "SELECT p.cell, CASE WHEN p.cell % 2 = 0 THEN CAST(p.cell AS DOUBLE) ELSE value END AS value FROM p LEFT JOIN v_raster r ON r.gcol = floor(x + 0.5e0) AND r.grow = floor(y + 0.5e0)", _POINTS))
def j17_nearest(spark, sf):
    own = _unwrapped(spark, sf).withColumn("mine", F.when(F.col("cell") % 2 == 0, F.col("cell").cast("double")))
    return grid.regrid(view(spark, sf, "v_raster"), SPEC, own, "nearest", keep="mine").select("cell", "value")


@query("j20_uncovered", oracle("v_raster v_admin", "SELECT level2 FROM v_raster JOIN v_admin USING (cell) WHERE gcol < 12 GROUP BY 1 HAVING count(value) = 0"))
def j20(spark, sf):
    return grid.uncovered_zones(view(spark, sf, "v_raster").filter("gcol < 12").join(view(spark, sf, "v_admin"), "cell"), "level2", "value")


@query("j21_match_resolution", oracle("v_raster v_admin", "SELECT bcol, brow, code, border FROM (SELECT *, row_number() OVER (PARTITION BY bcol, brow ORDER BY n DESC, loc) AS r, max(b) OVER (PARTITION BY bcol, brow) AS border FROM m) WHERE r = 1", f"m AS (SELECT {_B}, level0 AS code, count(*) AS n, min(cell) AS loc, max(cell % 3) AS b FROM v_raster JOIN v_admin USING (cell) GROUP BY ALL)"))
def j21(spark, sf):
    a = view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell").withColumn("code", F.col("level0")).withColumn("border", F.col("cell") % 3)
    return grid.match_resolution(a, 2, 4)


@query("o01_index_codes", oracle("", "SELECT code, CAST(row_number() OVER (ORDER BY CASE WHEN code = 'No land' THEN 2 WHEN split THEN 3 WHEN starts_with(code, 'X') THEN 1 ELSE 0 END, code) - 1 AS INT) AS idx FROM (SELECT CASE WHEN n_nationkey % 6 = 0 THEN concat('X', n_name) ELSE n_name END AS code, n_nationkey % 5 = 1 AS split FROM nation UNION ALL SELECT 'No land', false)"))
def o01(spark, sf):
    n = table(spark, sf, "nation")
    code = F.when(F.col("n_nationkey") % 6 == 0, F.concat(F.lit("X"), "n_name")).otherwise(F.col("n_name"))
    codes = n.select(code.alias("code")).unionByName(spark.createDataFrame([("No land",)], "code string"))
    return grid.index_codes(codes, n.filter("n_nationkey % 5 = 1").select(code.alias("code")))


@query("o04_set_operations", oracle("v_admin v_river", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT cell FROM v_admin WHERE level0 < 9 INTERSECT SELECT next_cell FROM v_river) UNION ALL SELECT 'left', count(*) FROM (SELECT cell FROM v_admin WHERE level0 < 9 EXCEPT SELECT next_cell FROM v_river) UNION ALL SELECT 'any', count(*) FROM (SELECT cell FROM v_admin WHERE level0 < 9 UNION SELECT next_cell FROM v_river)"))
def o04(spark, sf):
    a = view(spark, sf, "v_admin").filter("level0 < 9").select("cell")
    b = view(spark, sf, "v_river").select(F.col("next_cell").alias("cell"))
    kinds = {"both": a.intersect(b), "left": a.subtract(b), "any": a.union(b).distinct()}
    out = None
    for k, d in kinds.items():
        one = d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("o05_source_precedence", oracle("v_series", "SELECT country, crop, year, coalesce(b.ha, a.ha) AS ha FROM (SELECT country, crop, year, ha FROM v_series WHERE year < 2000) a FULL JOIN (SELECT country, crop, year, ha * 2 AS ha FROM v_series WHERE year > 1997) b USING (country, crop, year)"))
def o05(spark, sf):
    from gridprep.operators.names import overlay_sources

    s = view(spark, sf, "v_series")
    return overlay_sources(s.filter("year < 2000"), s.filter("year > 1997").withColumn("ha", F.col("ha") * 2), ["country", "crop", "year"], "ha")
