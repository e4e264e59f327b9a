"""Queries of the series operators (W) and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridprep.operators import capacity, groups, series
from gridprep.plans.registry import query
from gridprep.plans.views import oracle, view

KEYS = ["country", "crop"]
#: The proxy on every year of the series, its interior gaps filled linearly.
_PROXY = """pl AS (SELECT *, last_value(cropland IGNORE NULLS) OVER f AS va, last_value(CASE WHEN cropland IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ya,
    first_value(cropland IGNORE NULLS) OVER b AS vb, first_value(CASE WHEN cropland IS NOT NULL THEN year END IGNORE NULLS) OVER b AS yb FROM v_proxy
    WINDOW f AS (PARTITION BY country ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY country ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  pc AS (SELECT country, year, coalesce(cropland, va + (vb - va) * (year - ya) / nullif(yb - ya, 0)) AS c FROM pl)"""
_FILL = _PROXY + """, s AS (SELECT country, crop, year, ha AS h, c FROM v_series LEFT JOIN pc USING (country, year)),
  e AS (SELECT *, last_value(h IGNORE NULLS) OVER f AS ha, last_value(CASE WHEN h IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ya, last_value(CASE WHEN h IS NOT NULL THEN coalesce(c, -1) END IGNORE NULLS) OVER f AS ca,
    first_value(h IGNORE NULLS) OVER b AS hb, first_value(CASE WHEN h IS NOT NULL THEN year END IGNORE NULLS) OVER b AS yb, first_value(CASE WHEN h IS NOT NULL THEN coalesce(c, -1) END IGNORE NULLS) OVER b AS cb FROM s
    WINDOW f AS (PARTITION BY country, crop ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY country, crop ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  g AS (SELECT *, min(CASE WHEN h IS NULL AND c > 0 THEN year END) OVER k AS fy, max(CASE WHEN h IS NULL AND c > 0 THEN year END) OVER k AS ly FROM e WINDOW k AS (PARTITION BY country, crop, ya, yb)),
  q AS (SELECT *, max(CASE WHEN year = fy THEN c END) OVER k AS cf, max(CASE WHEN year = ly THEN c END) OVER k AS cl, ha + (hb - ha) * (fy - ya) / nullif(yb - ya, 0) AS lf, ha + (hb - ha) * (ly - ya) / nullif(yb - ya, 0) AS ll, ha + (hb - ha) * (year - ya) / nullif(yb - ya, 0) AS ln FROM g WINDOW k AS (PARTITION BY country, crop, ya, yb)),
  filled AS (SELECT country, crop, year, h IS NULL AS missing, CASE WHEN h IS NOT NULL THEN h WHEN ya IS NULL THEN CASE WHEN cb > 0 AND fy IS NOT NULL THEN c * hb / cb END WHEN yb IS NULL THEN CASE WHEN ca > 0 AND fy IS NOT NULL THEN c * ha / ca END
    WHEN fy IS NULL OR NOT ca > 0 AND NOT cb > 0 THEN ln WHEN ca > 0 AND cb > 0 THEN (ha / ca + (hb / cb - ha / ca) * (year - ya) / (yb - ya)) * c
    WHEN ca > 0 THEN CASE WHEN year >= ly THEN ln ELSE (ha / ca + (ll / cl - ha / ca) * (year - ya) / (ly - ya)) * c END
    ELSE CASE WHEN year <= fy THEN ln ELSE (lf / cf + (hb / cb - lf / cf) * (year - fy) / (yb - fy)) * c END END AS ha FROM q)"""


def _filled(spark, sf):
    proxy = series.interpolate(series.densify(view(spark, sf, "v_proxy"), ["country"]), ["country"], "cropland").withColumnRenamed("cropland", "c")
    s = series.densify(view(spark, sf, "v_series"), KEYS).join(proxy, ["country", "year"], "left")
    return series.fill_series_chain(s, KEYS, "ha", ["c"])


_LINE = """l AS (SELECT *, last_value(ha IGNORE NULLS) OVER f AS va, last_value(CASE WHEN ha IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ya, first_value(ha IGNORE NULLS) OVER b AS vb, first_value(CASE WHEN ha IS NOT NULL THEN year END IGNORE NULLS) OVER b AS yb FROM v_series
    WINDOW f AS (PARTITION BY country, crop ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY country, crop ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("w01_interpolate", oracle("v_series", "SELECT country, crop, year, round(coalesce(ha, va + (vb - va) * (year - ya) / nullif(yb - ya, 0)), 4) AS ha FROM l", _LINE))
def w01(spark, sf):
    return series.interpolate(view(spark, sf, "v_series"), KEYS, "ha").select(*KEYS, "year", F.round("ha", 4).alias("ha"))


@query("w02_densify", oracle("v_slices", "SELECT cell, CAST(y AS INT) AS year, round(value, 2) AS value FROM (SELECT cell, unnest(range(min(year), max(year) + 1)) AS y FROM v_slices GROUP BY cell) d LEFT JOIN v_slices s USING (cell) WHERE false UNION ALL SELECT d.cell, CAST(d.y AS INT), round(s.value, 2) FROM (SELECT cell, unnest(range(min(year), max(year) + 1)) AS y FROM v_slices GROUP BY cell) d LEFT JOIN v_slices s ON s.cell = d.cell AND s.year = d.y"))
def w02(spark, sf):
    return series.densify(view(spark, sf, "v_slices"), ["cell"]).select("cell", "year", F.round("value", 2).alias("value"))


@query("w03_fill_series", oracle("v_series v_proxy", "SELECT country, crop, year, round(ha, 4) AS ha, missing AND ha IS NOT NULL AS is_filled FROM filled", _FILL))
def w03(spark, sf):
    return _filled(spark, sf).select(*KEYS, "year", F.round("ha", 4).alias("ha"), "is_filled")


@query(
    "w05_fill_scale_rollup",
    oracle("v_series v_proxy v_groups", "SELECT grp, crop, year, round(sum(ha * CASE WHEN cap <= 0 THEN 0 ELSE least(1, coalesce(cap / nullif(tot, 0), 1)) END), 3) AS ha, bool_or(is_filled) AS is_filled FROM t JOIN v_groups USING (country) GROUP BY 1, 2, 3",
           _FILL + ", t AS (SELECT f.country, f.crop, f.year, f.ha, missing AND f.ha IS NOT NULL AS is_filled, coalesce(c * 20, 0) AS cap, sum(f.ha) OVER (PARTITION BY f.country, f.year) AS tot FROM filled f LEFT JOIN pc USING (country, year))"),
)
def w05(spark, sf):
    """The flagship: area per group, crop and year, gaps filled along crop land, scaled to capacity, rolled up."""
    s = _filled(spark, sf).withColumn("cap", F.coalesce(F.col("c") * 20, F.lit(0.0)))
    s = capacity.scale_to_cap(s, ["country", "year"], "ha", "cap")
    return groups.rollup_groups(s, view(spark, sf, "v_groups"), ["crop", "year"], "ha", "is_filled").select("grp", "crop", "year", F.round("ha", 3).alias("ha"), "is_filled")


_SLICE = """y AS (SELECT cell, unnest(range(min(year), max(year) + 1)) AS year FROM v_slices WHERE year <= 1997 GROUP BY cell), v AS (SELECT y.cell, y.year, s.value FROM y LEFT JOIN v_slices s ON s.cell = y.cell AND s.year = y.year),
  i AS (SELECT *, lag(value) OVER w AS va, lead(value) OVER w AS vb FROM v WINDOW w AS (PARTITION BY cell ORDER BY year))"""


@query("w06_annualise", oracle("v_slices", "SELECT cell, CAST(year AS INT) AS year, round(coalesce(value, (va + vb) / 2), 3) AS value FROM i UNION ALL SELECT cell, year, round(value, 3) FROM v_slices WHERE year > 1997", _SLICE))
def w06(spark, sf):
    return series.annualise(view(spark, sf, "v_slices"), ["cell"], "value", 1997).select("cell", "year", F.round("value", 3).alias("value"))


@query("w07_relative", oracle("v_series", "SELECT country, crop, year, round(ha / nullif(max(CASE WHEN year = 1998 THEN ha END) OVER (PARTITION BY country, crop), 0), 6) AS ratio FROM v_series"))
def w07(spark, sf):
    return series.relative_to(view(spark, sf, "v_series"), KEYS, "ha", 1998).select(*KEYS, "year", F.round("ha", 6).alias("ratio"))


@query("w08_lifetime", oracle("v_series v_lifetime", "SELECT s.country, crop, year, CASE WHEN year < start_year OR year > end_year AND s.country IN (SELECT parent FROM v_lifetime WHERE country IN (SELECT country FROM v_series)) THEN NULL ELSE ha END AS ha FROM v_series s LEFT JOIN v_lifetime l ON l.country = s.country"))
def w08(spark, sf):
    return series.apply_lifetime(view(spark, sf, "v_series"), view(spark, sf, "v_lifetime"), "country", "ha").select("country", "crop", "year", "ha")


@query("w08_successor_sum", oracle("v_series v_lifetime", "SELECT CAST(parent AS INT) AS parent, crop, year, sum(ha) AS ha, count(ha) = (SELECT count(*) FROM v_lifetime x WHERE x.parent = l.parent) AS complete FROM v_series s JOIN v_lifetime l ON l.country = s.country WHERE parent IS NOT NULL GROUP BY l.parent, crop, year"))
def w08_sum(spark, sf):
    return series.successor_sum(view(spark, sf, "v_series"), view(spark, sf, "v_lifetime"), "country", "ha", ["crop"])


@query("w09_extend", oracle("v_series", "SELECT country, crop, year, CASE WHEN ha IS NOT NULL THEN ha WHEN va IS NULL THEN vb WHEN vb IS NULL THEN va END AS ha FROM l", _LINE))
def w09(spark, sf):
    return series.extend_flat(view(spark, sf, "v_series"), KEYS, "ha").select(*KEYS, "year", "ha")


@query("w10_top1", oracle("v_series", "SELECT country, crop, year, ha FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY ha DESC, crop, year) AS r FROM v_series WHERE ha IS NOT NULL) WHERE r = 1"))
def w10(spark, sf):
    s = view(spark, sf, "v_series").filter("ha is not null")
    rank = F.min_by(F.struct("crop", "year", "ha"), F.struct((-F.col("ha")).alias("a"), "crop", "year")).alias("b")
    return s.groupBy("country").agg(rank).select("country", "b.crop", "b.year", "b.ha")


@query("w12_smallest_group", oracle("v_series v_groups", "SELECT country, grp FROM (SELECT country, grp, row_number() OVER (PARTITION BY country ORDER BY n, grp) AS r FROM v_groups JOIN (SELECT grp, count(*) AS n FROM v_groups GROUP BY 1) z USING (grp) WHERE grp IN (SELECT grp FROM v_groups JOIN v_series USING (country) WHERE ha > 300)) WHERE r = 1"))
def w12(spark, sf):
    g = view(spark, sf, "v_groups")
    return series.smallest_group(g, g.join(view(spark, sf, "v_series").filter("ha > 300").select("country").distinct(), "country"))
