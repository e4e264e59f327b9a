"""Queries of names (J04-J06, J12-J19, A21, A25, S05), crops (A04-A26, G02-G04, G16), soil, overlay and nutrients."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridprep.functions.geo import EARTH_RADIUS, GridSpec
from gridprep.operators import crops, groups, names, nutrients, overlay, soil
from gridprep.operators.medians import exact_medians
from gridprep.operators.unions import polygon_cell_union
from gridprep.plans.registry import query
from gridprep.plans.views import oracle, table, view
from gridprep.session import reliable_cut

KEYS = ["country", "crop", "year"]


# names and codes


@query("j04_country_cells", oracle("v_groups v_admin", "SELECT grp AS name, cell FROM v_groups JOIN v_admin ON level0 = country"))
def j04(spark, sf):
    mapping = view(spark, sf, "v_groups").groupBy(F.col("grp").alias("name")).agg(F.collect_list("country").alias("codes"))
    return names.country_cells(mapping, view(spark, sf, "v_admin").select("cell", F.col("level0").alias("code")))


@query("j05_match_prioritised", oracle("", "SELECT p.p_partkey AS id, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'code' WHEN b.v IS NOT NULL THEN 'name' END AS matched_by FROM part p LEFT JOIN (SELECT CAST(floor(p_retailprice) AS BIGINT) % 900 AS code, min(p_partkey) AS v FROM part GROUP BY 1) a ON a.code = p.p_size * 10 LEFT JOIN (SELECT p_brand AS name, min(p_partkey) AS v FROM part WHERE p_size > 48 GROUP BY 1) b ON b.name = p.p_brand"))
def j05(spark, sf):
    p = table(spark, sf, "part")
    r = p.select((F.floor("p_retailprice").cast("long") % 900).alias("code"), F.when(F.col("p_size") > 48, F.col("p_brand")).alias("name"), F.col("p_partkey").alias("v"))
    left = p.select(F.col("p_partkey").alias("id"), (F.col("p_size") * 10).cast("long").alias("code"), F.col("p_brand").alias("name"))
    return names.match_prioritised(left, r, ["code", "name"], "v").select("id", "v", "matched_by")


_NAMES = """n AS (SELECT min(p_partkey) AS id, p_name AS a FROM part GROUP BY 2), r AS (SELECT DISTINCT CASE WHEN id % 3 = 0 THEN a ELSE concat(substr(a, 1, 3), substr(a, 5)) END AS m FROM n),
  e1 AS (SELECT m AS match, min(id) AS id FROM n JOIN r ON a = m GROUP BY 1), n1 AS (SELECT * FROM n WHERE id NOT IN (SELECT id FROM e1)), r1 AS (SELECT * FROM r WHERE m NOT IN (SELECT match FROM e1)),
  e2 AS (SELECT m AS match, min(id) AS id FROM n1 JOIN r1 ON upper(a) = m GROUP BY 1),
  near AS (SELECT id, m AS match, levenshtein(a, m) AS d FROM n1, r1 WHERE id NOT IN (SELECT id FROM e2) AND m NOT IN (SELECT match FROM e2) AND levenshtein(a, m) * 2 < length(a)),
  g AS (SELECT 0 AS turn, id, match, d, false AS hit FROM near UNION ALL SELECT turn + 1, id, match, d, row_number() OVER (PARTITION BY id ORDER BY d, id, match) = 1 AND row_number() OVER (PARTITION BY match ORDER BY d, id, match) = 1
    FROM (SELECT *, bool_or(hit) OVER (PARTITION BY id) AS mine, bool_or(hit) OVER (PARTITION BY match) AS theirs FROM g) WHERE NOT mine AND NOT theirs)"""


@query("j06_fuzzy_match", oracle("", "WITH RECURSIVE " + _NAMES + " SELECT id, match, 'distance' AS how FROM g WHERE hit UNION ALL SELECT id, match, 'name_a' FROM e1 UNION ALL SELECT id, match, 'name_b' FROM e2"))
def j06(spark, sf):
    n = table(spark, sf, "part").groupBy(F.col("p_name").alias("name_a")).agg(F.min("p_partkey").alias("id"))
    right = n.select(F.when(F.col("id") % 3 == 0, F.col("name_a")).otherwise(F.concat(F.substring("name_a", 1, 3), F.substring("name_a", 5, 100))).alias("name"))
    left = n.withColumn("name_b", F.upper("name_a"))
    return names.fuzzy_match(left, right, cut=reliable_cut)


@query("j12_remap_codes", oracle("", "SELECT n_nationkey AS id, CASE WHEN n_nationkey < 4 THEN n_nationkey + 20 WHEN n_nationkey % 2 = 0 THEN n_nationkey WHEN n_regionkey * 2 % 2 = 0 THEN n_regionkey * 2 END AS new_code FROM nation"))
def j12(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").alias("code"), F.array(F.col("n_regionkey") * 2 + 1, F.col("n_regionkey") * 2, F.lit(8)).alias("around"))
    rules = n.filter("code < 4").select("code", (F.col("code") + 20).alias("replacement"))
    return names.remap_codes(n, rules, n.filter("code % 2 = 0"), enclosing="around").select("id", "new_code")


@query("j13_template", oracle("", "SELECT n_name AS name, n_nationkey AS code, n_regionkey AS region FROM nation UNION ALL SELECT concat('New ', n_name), n_nationkey + 100, n_regionkey FROM nation WHERE n_nationkey BETWEEN 10 AND 14"))
def j13(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("region"))
    add = n.filter("code >= 10").select(F.concat(F.lit("New "), "name").alias("name"), F.when(F.col("code") > 14, F.col("code")).otherwise(F.col("code") + 100).alias("code"), F.col("name").alias("template"))
    return names.add_from_template(n, add)


_OVERLAPS = """m AS (SELECT grp AS name, country AS code FROM v_groups UNION SELECT concat('c', CAST(country AS VARCHAR)), country FROM v_groups), a AS (SELECT year, name FROM (SELECT DISTINCT name FROM m WHERE name <> 'World') CROSS JOIN (SELECT DISTINCT year FROM v_series)),
  dt AS (SELECT year, name FROM a WHERE name <> 'c3' OR year > 1998), sz AS (SELECT name, count(*) AS size FROM m GROUP BY 1), am AS (SELECT * FROM a JOIN m USING (name) JOIN sz USING (name)),
  met AS (SELECT x.year, x.name, x.size, x.code, p.name AS part FROM am x JOIN am p ON p.year = x.year AND p.code = x.code AND p.name <> x.name AND (p.size < x.size OR p.size = x.size AND p.name < x.name)),
  v AS (SELECT met.year, met.name, count(DISTINCT code) = any_value(size) AND bool_and(dt.name IS NOT NULL) AS whole FROM met LEFT JOIN dt ON dt.year = met.year AND dt.name = met.part GROUP BY 1, 2),
  gone AS (SELECT year, name FROM v WHERE whole UNION SELECT met.year, part FROM met JOIN v ON v.year = met.year AND v.name = met.name WHERE NOT whole)"""


@query("j18_overlaps", oracle("v_groups v_series", "SELECT year, name FROM a EXCEPT SELECT year, name FROM gone", _OVERLAPS))
def j18(spark, sf):
    g = view(spark, sf, "v_groups")
    single = g.select("country", F.concat(F.lit("c"), F.col("country").cast("string")).alias("grp")).distinct()
    mapping = g.unionByName(single).select(F.col("grp").alias("name"), F.col("country").alias("code"))
    years = view(spark, sf, "v_series").select("year").distinct()
    active = mapping.filter("name <> 'World'").select("name").distinct().crossJoin(F.broadcast(years)).select("year", "name")
    data = active.filter((F.col("name") != "c3") | (F.col("year") > 1998))
    return names.resolve_overlaps(active, mapping, data)


@query("j19_dedupe_mapping", oracle("v_groups", "SELECT name, array_to_string(codes, ',') AS codes FROM (SELECT *, count(*) OVER (PARTITION BY codes) AS n, bool_or(ok) OVER (PARTITION BY codes) AS o FROM (SELECT name, list_sort(list(DISTINCT code)) AS codes, NOT ends_with(name, '_2') AND name <> 'Even' AS ok FROM (SELECT grp AS name, country AS code FROM v_groups UNION ALL SELECT concat(grp, '_2'), country FROM v_groups) GROUP BY name)) WHERE n = 1 OR ok OR NOT o"))
def j19(spark, sf):
    g = view(spark, sf, "v_groups").select(F.col("grp").alias("name"), F.col("country").alias("code"))
    both = g.unionByName(g.withColumn("name", F.concat("name", F.lit("_2"))))
    out = names.dedupe_mapping(both, g.filter("name <> 'Even'").select("name"))
    return out.select("name", F.array_join(F.transform("codes", lambda c: c.cast("string")), ",").alias("codes"))


@query("a21_key_diff", oracle("v_series", "SELECT country, crop, 'a' AS side FROM (SELECT DISTINCT country, crop FROM v_series WHERE ha > 200 EXCEPT SELECT DISTINCT country, crop FROM v_series WHERE ha < 150) UNION ALL SELECT country, crop, 'b' FROM (SELECT DISTINCT country, crop FROM v_series WHERE ha < 150 EXCEPT SELECT DISTINCT country, crop FROM v_series WHERE ha > 200)"))
def a21(spark, sf):
    s = view(spark, sf, "v_series")
    return names.key_diff(s.filter("ha > 200"), s.filter("ha < 150"), ["country", "crop"])


@query("a25_order_levels", oracle("v_admin", "SELECT 'level0' AS level, count(DISTINCT level0) AS n FROM v_admin UNION ALL SELECT 'level1', count(DISTINCT level1) FROM v_admin UNION ALL SELECT 'level2', count(DISTINCT level2) FROM v_admin"))
def a25(spark, sf):
    return names.order_levels(view(spark, sf, "v_admin"), ["level0", "level1", "level2"])


@query("s05_unpivot_years", oracle("v_series", "SELECT country, crop, CAST(y AS INT) AS year, s.ha AS value, CASE WHEN s.ha IS NOT NULL THEN 'X' END AS flag FROM (SELECT DISTINCT country, crop FROM v_series) k CROSS JOIN range(1995, 2002) r(y) LEFT JOIN v_series s USING (country, crop) WHERE s.year = y"))
def s05(spark, sf):
    s = view(spark, sf, "v_series")
    years = range(1995, 2002)
    wide = s.groupBy("country", "crop").agg(*(F.max(F.when(F.col("year") == y, F.col("ha"))).alias(f"Y{y}") for y in years), *(F.max(F.when((F.col("year") == y) & F.col("ha").isNotNull(), "X")).alias(f"Y{y}F") for y in years))
    return names.unpivot_years(wide, ["country", "crop"])


# crops


@query("a04_zonal_sum", oracle("v_admin v_raster v_groups", "SELECT grp AS zone, class, round(sum(value), 2) AS value FROM v_raster JOIN v_admin USING (cell) JOIN v_groups ON country = level0 GROUP BY 1, 2"))
def a04(spark, sf):
    zones = view(spark, sf, "v_admin").join(view(spark, sf, "v_groups"), F.col("level0") == F.col("country")).select(F.col("grp").alias("zone"), "cell")
    return crops.zonal_sum(view(spark, sf, "v_raster"), zones, "value", ["class"]).select("zone", "class", F.round("value", 2).alias("value"))


_QUALITY = "z AS (SELECT level1 AS zone, level0, cell, cropland, cell % 3 <> 0 AS present, cell % 7 = 0 AS border, (cell % 4) / 3e0 AS quality FROM v_parts JOIN v_admin USING (cell) WHERE cell % 5 <> 0 OR level1 % 2 = 0), ql AS (SELECT zone, max(quality) AS quality, count_if(present) / count(*) AS presence, CASE WHEN count(*) = 1 THEN -1 ELSE count_if(present AND border) / nullif(count_if(present), 0) END AS border_share, count(*) AS cells FROM z WHERE cropland > 0 GROUP BY 1)"


def _quality(spark, sf, zone="level1"):
    z = view(spark, sf, "v_parts").join(view(spark, sf, "v_admin"), "cell").filter("cell % 5 <> 0 or level1 % 2 = 0")
    z = z.select(F.col(zone).alias("zone"), "level0", "level1", "level2", "cell", "cropland", (F.col("cell") % 3 != 0).alias("present"), (F.col("cell") % 7 == 0).alias("border"), ((F.col("cell") % 4) / 3).alias("quality"))
    return z, crops.zonal_quality(z)


@query("a05_zonal_quality", oracle("v_parts v_admin", "SELECT zone, round(quality, 6) AS quality, round(presence, 6) AS presence, round(border_share, 6) AS border_share, cells FROM ql", _QUALITY))
def a05(spark, sf):
    return _quality(spark, sf)[1].select("zone", *(F.round(c, 6).alias(c) for c in ("quality", "presence", "border_share")), "cells")


@query("a11_rollup_groups", oracle("v_series v_groups", "SELECT grp, crop, year, round(sum(ha), 3) AS ha, bool_or(ha IS NULL) AS filled FROM v_series JOIN v_groups USING (country) GROUP BY 1, 2, 3"))
def a11(spark, sf):
    s = view(spark, sf, "v_series").withColumn("filled", F.col("ha").isNull())
    return groups.rollup_groups(s, view(spark, sf, "v_groups"), ["crop", "year"], "ha", "filled").select("grp", "crop", "year", F.round("ha", 3).alias("ha"), "filled")


_ITEMS = "i AS (SELECT country, year, crop AS item, ha AS value FROM v_series UNION ALL SELECT country, year, g, sum(ha) * CASE WHEN g = 'G1' THEN 1 WHEN country < 3 AND g = 'G0' THEN 1.5e0 WHEN g = 'G2' THEN 1.2e0 ELSE 1 END FROM (SELECT *, concat('G', CAST(length(crop) % 3 AS VARCHAR)) AS g FROM v_series) GROUP BY country, year, g), b AS (SELECT country, year, concat('G', CAST(length(crop) % 3 AS VARCHAR)) AS grp, sum(ha) AS built FROM v_series GROUP BY ALL)"


@query("a12_rollup_items", oracle("v_series", "SELECT country, year, grp, round(built, 3) AS value FROM b WHERE grp IN (SELECT b.grp FROM b LEFT JOIN i ON i.country = b.country AND i.year = b.year AND i.item = b.grp GROUP BY 1 HAVING count_if(abs(value - built) > abs(built) * 0.01e0 AND abs(value - built) > 2) <= 25)", _ITEMS))
def a12(spark, sf):
    s = view(spark, sf, "v_series").withColumn("g", F.concat(F.lit("G"), (F.length("crop") % 3).cast("string")))
    off = F.when(F.col("g") == "G1", 1.0).when((F.col("country") < 3) & (F.col("g") == "G0"), 1.5).when(F.col("g") == "G2", 1.2).otherwise(1.0)
    given = s.groupBy("country", "year", "g").agg(F.sum("ha").alias("ha")).withColumn("ha", F.col("ha") * off)
    items = s.select("country", "year", F.col("crop").alias("item"), F.col("ha").alias("value")).unionByName(given.select("country", "year", F.col("g").alias("item"), F.col("ha").alias("value")))
    members = s.select(F.col("crop").alias("item"), F.col("g").alias("grp")).distinct()
    return crops.rollup_items(items, members, ["country", "year"], most=25).select("country", "year", "grp", F.round("value", 3).alias("value"))


_TYPES = "m AS (SELECT DISTINCT crop, concat('T', CAST(length(crop) % 2 AS VARCHAR)) AS type FROM v_series UNION ALL SELECT DISTINCT crop, 'TX' FROM v_series WHERE length(crop) = 5)"


def _types(spark, sf):
    c = view(spark, sf, "v_series").select("crop").distinct()
    return c.select("crop", F.concat(F.lit("T"), (F.length("crop") % 2).cast("string")).alias("type")).unionByName(c.filter("length(crop) = 5").select("crop", F.lit("TX").alias("type")))


@query("a16_map_sum", oracle("v_series", "SELECT country, year, type, round(sum(ha), 3) AS ha FROM v_series JOIN m USING (crop) GROUP BY 1, 2, 3", _TYPES))
def a16(spark, sf):
    return crops.map_sum(view(spark, sf, "v_series"), _types(spark, sf), ["country", "year"], "ha").select("country", "year", "type", F.round("ha", 3).alias("ha"))


@query("a16_double_mapped", oracle("v_series", "SELECT crop, count(*) AS n FROM m GROUP BY 1 HAVING count(*) > 1", _TYPES))
def a16_double(spark, sf):
    return crops.double_mapped(_types(spark, sf))


_FRACTIONS = "f AS (SELECT crop, 'A' AS class, CASE WHEN length(crop) % 2 = 0 THEN 0.25e0 ELSE 1 END AS share FROM (SELECT DISTINCT crop FROM v_series) UNION ALL SELECT crop, 'B', 0.75e0 FROM (SELECT DISTINCT crop FROM v_series) WHERE length(crop) % 2 = 0)"


def _fractions(spark, sf):
    c = view(spark, sf, "v_series").select("crop").distinct()
    return crops.parse_fractions(c.withColumn("classes", F.when(F.length("crop") % 2 == 0, "A 0.25 B 0.75").otherwise("A")))


@query("a17_split_map", oracle("v_series", "SELECT country, year, class, round(sum(ha * share), 3) AS ha FROM v_series JOIN f USING (crop) GROUP BY 1, 2, 3", _FRACTIONS))
def a17(spark, sf):
    return crops.split_map(view(spark, sf, "v_series"), _fractions(spark, sf), ["country", "year"], "ha").select("country", "year", "class", F.round("ha", 3).alias("ha"))


@query("a17_unsplit", oracle("v_series", "SELECT country, year, crop, round(sum(2 * tot * own / nullif(w, 0)), 3) AS ha FROM (SELECT s.country, s.year, s.crop, class, ha * share AS own, sum(ha * share) OVER (PARTITION BY s.country, s.year, class) AS w FROM v_series s JOIN f USING (crop)) o JOIN (SELECT country, year, class, sum(ha * share) AS tot FROM v_series JOIN f USING (crop) GROUP BY 1, 2, 3) c USING (country, year, class) GROUP BY 1, 2, 3", _FRACTIONS))
def a17_unsplit(spark, sf):
    s, f = view(spark, sf, "v_series"), _fractions(spark, sf)
    classes = crops.split_map(s, f, ["country", "year"], "ha").withColumn("ha", F.col("ha") * 2)
    return crops.unsplit(classes, s, f, ["country", "year"], "ha").select("country", "year", "crop", F.round("ha", 3).alias("ha"))


_SHARES = "us AS (SELECT level0, min(n1) AS m1, min(n2) AS m2, any_value(n0) AS n0 FROM (SELECT level0, count(*) OVER (PARTITION BY level0) AS n0, count(*) OVER (PARTITION BY level0, level1) AS n1, count(*) OVER (PARTITION BY level0, level2) AS n2 FROM v_parts JOIN v_admin USING (cell) WHERE cropland > 0) GROUP BY 1)"


@query("a20_min_unit_share", oracle("v_parts v_admin", "SELECT level0, round(m1 / n0 * 0.75e0, 6) AS share_level1, round(m2 / n0 * 0.75e0, 6) AS share_level2 FROM us", _SHARES))
def a20(spark, sf):
    z = view(spark, sf, "v_parts").join(view(spark, sf, "v_admin"), "cell")
    return crops.min_unit_share(z, ["level1", "level2"], "level0").select("level0", F.round("share_level1", 6).alias("share_level1"), F.round("share_level2", 6).alias("share_level2"))


@query("g04_use_pattern", oracle("v_parts v_admin", "SELECT level0, coalesce(coalesce(border_share, 0) < 0.6e0 AND area >= 1 AND (presence >= CASE WHEN quality <= 0.25e0 THEN 0.75e0 WHEN quality <= 0.75e0 THEN m1 / n0 * 0.75e0 ELSE m2 / n0 * 0.75e0 END OR border_share < 0), false) AS use FROM (SELECT level0, max(quality) AS quality, count_if(present) / count(*) AS presence, CASE WHEN count(*) = 1 THEN -1 ELSE count_if(present AND border) / nullif(count_if(present), 0) END AS border_share, sum(cropland) AS area FROM (SELECT level0, cropland, cell % 3 <> 0 AS present, cell % 7 = 0 AS border, CASE WHEN level0 % 3 = 0 THEN 0.1e0 WHEN level0 % 3 = 1 THEN 0.5e0 ELSE 1 END AS quality FROM v_parts JOIN v_admin USING (cell) WHERE cropland > 0) GROUP BY 1) q JOIN us USING (level0)", _SHARES))
def g04(spark, sf):
    z = view(spark, sf, "v_parts").join(view(spark, sf, "v_admin"), "cell")
    flag = F.when(F.col("level0") % 3 == 0, 0.1).when(F.col("level0") % 3 == 1, 0.5).otherwise(1.0)
    cells = z.select(F.col("level0").alias("zone"), "cropland", (F.col("cell") % 3 != 0).alias("present"), (F.col("cell") % 7 == 0).alias("border"), flag.alias("quality"))
    area = cells.filter("cropland > 0").groupBy("zone").agg(F.sum("cropland").alias("area"))
    q = crops.zonal_quality(cells).join(area, "zone").withColumnRenamed("zone", "level0")
    shares = crops.min_unit_share(z, ["level1", "level2"], "level0").withColumn("whole", F.lit(0.75))
    return crops.use_pattern(q, shares, "level0", ["whole", "share_level1", "share_level2"])


_INTENSITY = "hi AS (SELECT p.cell, level2, level1, level0, cropland, CASE WHEN cropland > 0 AND p.cell % 3 <> 0 AND level0 <> 7 THEN rainfed * 2 / cropland END AS v FROM v_parts p JOIN v_admin USING (cell))"


def _intensity(spark, sf):
    p = view(spark, sf, "v_parts").join(view(spark, sf, "v_admin"), "cell")
    ha = p.filter("cell % 3 <> 0").select("cell", F.explode(F.array("rainfed", "rainfed")).alias("area"))
    bad = spark.createDataFrame([(7,)], "zone int")
    i = crops.intensity(ha, p.select("cell", F.col("level0").alias("zone"), "cropland"), bad)
    return i, i.join(p.select("cell", "level0", "level1", "level2", "cropland"), "cell")


@query("g02_intensity", oracle("v_parts v_admin", "SELECT cell, level0 AS zone, round(v, 6) AS intensity FROM hi", _INTENSITY))
def g02(spark, sf):
    return _intensity(spark, sf)[0].select("cell", "zone", F.round("intensity", 6).alias("intensity"))


_HIER = _INTENSITY + ", hm AS (SELECT *, sum(v * cropland) OVER (PARTITION BY level2) / nullif(sum(CASE WHEN v IS NOT NULL THEN cropland END) OVER (PARTITION BY level2), 0) AS a, sum(v * cropland) OVER (PARTITION BY level1) / nullif(sum(CASE WHEN v IS NOT NULL THEN cropland END) OVER (PARTITION BY level1), 0) AS b, sum(v * cropland) OVER (PARTITION BY level0) / nullif(sum(CASE WHEN v IS NOT NULL THEN cropland END) OVER (PARTITION BY level0), 0) AS c FROM hi), hf AS (SELECT cell, level0, CASE WHEN v IS NULL AND cropland > 0 THEN coalesce(a, b, c) ELSE v END AS v, CAST(CASE WHEN v IS NOT NULL THEN 0 WHEN cropland > 0 THEN CASE WHEN a IS NOT NULL THEN 1 WHEN b IS NOT NULL THEN 2 WHEN c IS NOT NULL THEN 3 END END AS INT) AS fill_level FROM hm)"


@query("g03_hier_fill", oracle("v_parts v_admin", "SELECT cell, round(v, 6) AS intensity, fill_level FROM hf", _HIER))
def g03(spark, sf):
    return crops.hier_fill(_intensity(spark, sf)[1], ["level2", "level1", "level0"], "intensity", "cropland").select("cell", F.round("intensity", 6).alias("intensity"), "fill_level")


@query("a23_fill_stats", oracle("v_parts v_admin", "SELECT level0, count(*) FILTER (WHERE fill_level = 0) AS level0_n, count(*) FILTER (WHERE fill_level = 1) AS level1_n, count(*) FILTER (WHERE fill_level = 2) AS level2_n, count(*) FILTER (WHERE fill_level = 3) AS level3_n, count(*) FILTER (WHERE fill_level IS NULL) AS failed FROM hf GROUP BY 1", _HIER))
def a23(spark, sf):
    f = crops.hier_fill(_intensity(spark, sf)[1], ["level2", "level1", "level0"], "intensity", "cropland")
    s = crops.fill_stats(f.drop("zone").withColumnRenamed("level0", "zone"), "zone")
    return s.select(F.col("zone").alias("level0"), *(F.col(f"level{k}").alias(f"level{k}_n") for k in range(4)), "failed")


@query("a24_min_positive", oracle("v_series", "SELECT country, crop, coalesce(max(CASE WHEN year = 1998 AND ha > 0 THEN ha END), min(CASE WHEN ha > 0 THEN ha END)) AS ha FROM v_series GROUP BY 1, 2"))
def a24(spark, sf):
    return crops.min_positive(view(spark, sf, "v_series"), ["country", "crop"], "ha", 1998)


@query("a26_presence_report", oracle("v_series", "SELECT country, crop, stat_area, pattern_area, CASE WHEN stat_area > 0 AND pattern_area > 0 THEN 'both' WHEN stat_area > 0 THEN 'statistics' WHEN pattern_area > 0 AND country % 2 = 0 THEN 'pattern accepted' WHEN pattern_area > 0 THEN 'pattern rejected' ELSE 'none' END AS status FROM (SELECT country, crop, ha AS stat_area FROM v_series WHERE year = 1996) a FULL JOIN (SELECT country, crop, ha AS pattern_area FROM v_series WHERE year = 1999 AND country > 3) b USING (country, crop)"))
def a26(spark, sf):
    s = view(spark, sf, "v_series").withColumnRenamed("ha", "area")
    return crops.presence_report(s.filter("year = 1996"), s.filter("year = 1999 and country > 3"), ["country", "crop"], s.filter("country % 2 = 0"))


_REFINE = "gr AS (SELECT DISTINCT concat('G', CAST(length(crop) % 3 AS VARCHAR)) AS grp, crop FROM v_series), pt AS (SELECT country, crop, ha AS area FROM v_series WHERE year = 1998 AND country % 5 <> 2), st AS (SELECT country, year, concat('G', CAST(length(crop) % 3 AS VARCHAR)) AS crop, sum(ha) AS value FROM v_series GROUP BY ALL UNION ALL SELECT country, year, crop, ha FROM v_series WHERE country = 4 AND length(crop) % 3 = 0), hp AS (SELECT DISTINCT country, year, grp FROM st JOIN gr USING (crop) WHERE value IS NOT NULL), sh AS (SELECT country, grp, crop AS part, area / sum(area) OVER (PARTITION BY country, grp) AS share FROM pt JOIN gr USING (crop) WHERE area > 0)"


@query("g16_refine_groups", oracle("v_series", "SELECT s.country, s.year, coalesce(part, crop) AS crop, round(value * coalesce(share, 1), 3) AS value FROM st s LEFT JOIN hp ON hp.country = s.country AND hp.year = s.year AND hp.grp = s.crop LEFT JOIN sh ON sh.country = s.country AND sh.grp = s.crop AND hp.grp IS NULL", _REFINE))
def g16(spark, sf):
    s = view(spark, sf, "v_series").withColumn("g", F.concat(F.lit("G"), (F.length("crop") % 3).cast("string")))
    groups_ = s.select(F.col("g").alias("grp"), "crop").distinct()
    stats = s.groupBy("country", "year", F.col("g").alias("crop")).agg(F.sum("ha").alias("value")).unionByName(s.filter("country = 4 and length(crop) % 3 = 0").select("country", "year", "crop", F.col("ha").alias("value")))
    pattern = s.filter("year = 1998 and country % 5 <> 2").select("country", "crop", F.col("ha").alias("area"))
    return crops.refine_groups(stats, groups_, pattern, ["country", "year"]).select("country", "year", "crop", F.round("value", 3).alias("value"))


@query("g16_add_missing", oracle("v_series v_proxy", "SELECT country, crop, year, ha AS value FROM v_series WHERE length(crop) <> 5 UNION ALL SELECT p.country, p.crop, l.year, round(p.ha * l.cropland / nullif(r.cropland, 0), 4) FROM v_series p JOIN v_proxy l ON l.country = p.country JOIN v_proxy r ON r.country = p.country AND r.year = 1998 WHERE p.year = 1998 AND p.ha > 0 AND length(p.crop) = 5"))
def g16_add(spark, sf):
    s = view(spark, sf, "v_series")
    pattern = s.filter("year = 1998").select("country", "crop", F.col("ha").alias("area"))
    out = crops.add_missing_crops(s.filter("length(crop) <> 5").withColumnRenamed("ha", "value"), pattern, view(spark, sf, "v_proxy"), 1998)
    return out.select("country", "crop", "year", F.round("value", 4).alias("value"))


@query("g16_borrow_mix", oracle("v_series v_proxy v_groups", "SELECT l.country, t.crop, t.year, round(t.v * l.cropland / nullif(b.base, 0), 4) AS value FROM (SELECT country, concat('R', CAST(n_regionkey AS VARCHAR)) AS grp FROM (SELECT n_nationkey AS country, n_regionkey FROM nation) WHERE country % 6 = 1) n JOIN v_proxy l USING (country) JOIN (SELECT grp, crop, year, sum(ha) AS v FROM v_series JOIN v_groups USING (country) WHERE ha IS NOT NULL AND country % 6 <> 1 GROUP BY 1, 2, 3) t ON t.grp = n.grp AND t.year = l.year JOIN (SELECT grp, year, sum(cropland) AS base FROM v_proxy JOIN v_groups USING (country) WHERE (country, year) IN (SELECT (country, year) FROM v_series WHERE ha IS NOT NULL AND country % 6 <> 1) GROUP BY 1, 2) b ON b.grp = n.grp AND b.year = l.year"))
def g16_borrow(spark, sf):
    s, g = view(spark, sf, "v_series").withColumnRenamed("ha", "value"), view(spark, sf, "v_groups")
    needy = g.filter("country % 6 = 1").select("country").distinct()
    region = g.filter("grp like 'R%'")
    return crops.borrow_mix(needy, region.join(needy, "country"), s.filter("country % 6 <> 1"), g, view(spark, sf, "v_proxy")).select("country", "crop", "year", F.round("value", 4).alias("value"))


# soil and overlay


_SOIL = """ov AS (SELECT floor(cell / 4) AS cell, cell % (SELECT max(mu) + 1 FROM v_soil) AS mu, sum(area) AS area FROM v_admin GROUP BY 1, 2),
  pc AS (SELECT o.cell, o.mu, CASE sym WHEN 'RK' THEN 100 WHEN 'GG' THEN 101 WHEN 'DS' THEN 1 ELSE texture END AS class, o.area * share AS w, ph FROM ov o JOIN v_soil s ON s.mu = o.mu),
  fi AS (SELECT cell, class, mu, sum(w) AS w, sum(w * ph) AS wp, sum(CASE WHEN ph IS NOT NULL THEN w END) AS wk FROM pc WHERE class IS NOT NULL AND w > 0 GROUP BY 1, 2, 3),
  fw AS (SELECT *, sum(w) OVER c AS cw, sum(wp) OVER c AS cp, sum(wk) OVER c AS ck, sum(wp) OVER u AS up, sum(wk) OVER u AS uk FROM fi WINDOW c AS (PARTITION BY cell, class), u AS (PARTITION BY cell, mu)),
  fb AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(cw, 6) DESC, class, round(w, 6) DESC, mu) AS r FROM fw)"""


@query("a13_soil_assign", oracle("v_admin v_soil", "SELECT CAST(cell AS BIGINT) AS cell, class, CAST(mu AS INT) AS mu, round(coalesce(wp / nullif(wk, 0), cp / nullif(ck, 0), up / nullif(uk, 0), CASE WHEN class >= 100 THEN 7 END), 6) AS ph, CAST(CASE WHEN wp / nullif(wk, 0) IS NOT NULL THEN 1 WHEN cp / nullif(ck, 0) IS NOT NULL THEN 2 WHEN up / nullif(uk, 0) IS NOT NULL THEN 3 WHEN class >= 100 THEN 4 END AS INT) AS ph_source FROM fb WHERE r = 1", _SOIL))
def a13(spark, sf):
    s = view(spark, sf, "v_soil")
    a = view(spark, sf, "v_admin").crossJoin(s.agg((F.max("mu") + 1).alias("units")))
    ov = a.groupBy(F.floor(F.col("cell") / 4).alias("cell"), (F.col("cell") % F.col("units")).cast("int").alias("mu")).agg(F.sum("area").alias("area"))
    return soil.soil_assign(ov, s).select("cell", "class", "mu", F.round("ph", 6).alias("ph"), "ph_source")


_WINDOW = "mv AS (SELECT m.cell, s.cell AS source, greatest(abs(m.gcol - s.gcol), abs(m.grow - s.grow)) AS reach FROM v_raster m JOIN v_raster s ON m.value IS NULL AND s.value IS NOT NULL AND abs(m.gcol - s.gcol) <= 8 AND abs(m.grow - s.grow) <= 8), mw AS (SELECT *, min(reach) OVER (PARTITION BY cell) AS win FROM mv)"


@query("g01_window_fill", oracle("v_raster", "SELECT cell, source, CAST(win AS INT) AS win FROM mw WHERE reach <= win", _WINDOW))
def g01(spark, sf):
    r = view(spark, sf, "v_raster")
    out = soil.window_fill(r.filter("value is not null"), r.filter("value is null"), GridSpec(167.5, 75.0, 0.5, 0.5, 50, 300))
    return out.select("cell", "source", F.col("window").cast("int").alias("win"))


_RECT = f"c AS (SELECT CAST(x AS INT) AS gcol, CAST(y AS INT) AS grow, -15 + 0.5e0 * x AS w, 12 - 0.5e0 * y AS n FROM range(100) a(x) CROSS JOIN range(60) b(y)), i AS (SELECT code, gcol, grow, greatest(0, least(xmax, w + 0.5e0) - greatest(xmin, w)) AS dx, greatest(ymin, n - 0.5e0) AS s, least(ymax, n) AS t FROM v_rects JOIN c ON w < xmax AND w + 0.5e0 > xmin AND n > ymin AND n - 0.5e0 < ymax), r AS (SELECT code, gcol, grow, sum(power({EARTH_RADIUS}e0, 2) * radians(dx) * (sin(radians(t)) - sin(radians(s)))) AS area FROM i WHERE dx > 0 AND t > s GROUP BY 1, 2, 3)"


@query("j03_polygon_cell_area", oracle("v_rects", "SELECT code, gcol, grow, round(area / 1e6, 2) AS km2 FROM r WHERE area > 1e4", _RECT))
def j03(spark, sf):
    r = view(spark, sf, "v_rects")
    corner = lambda x, y: F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))
    p = r.select("poly_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), "code", F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax")).alias("points"))
    out = overlay.polygon_cell_area(p, GridSpec(-15.0, 12.0, 0.5, 0.5, 100, 60))
    return out.filter("area > 1e4").select("code", "gcol", "grow", F.round(F.col("area") / 1e6, 2).alias("km2"))


_UNITED = """c AS (SELECT CAST(x AS INT) AS gcol, CAST(y AS INT) AS grow, -15 + 0.5e0 * x AS w, 12 - 0.5e0 * y AS n FROM range(100) a(x) CROSS JOIN range(60) b(y)),
  i AS (SELECT code, gcol, grow, greatest(xmin, w) AS x0, least(xmax, w + 0.5e0) AS x1, greatest(ymin, n - 0.5e0) AS s, least(ymax, n) AS t FROM v_rects JOIN c ON w < xmax AND w + 0.5e0 > xmin AND n > ymin AND n - 0.5e0 < ymax),
  k AS (SELECT code, gcol, grow, x0 AS x FROM i UNION SELECT code, gcol, grow, x1 FROM i), b AS (SELECT *, lead(x) OVER (PARTITION BY code, gcol, grow ORDER BY x) AS e FROM k),
  y AS (SELECT b.*, s, t, max(t) OVER (PARTITION BY code, gcol, grow, x ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM b JOIN i USING (code, gcol, grow) WHERE e IS NOT NULL AND x0 <= x AND x1 >= e),
  """ + f"r AS (SELECT code, gcol, grow, sum(power({EARTH_RADIUS}e0, 2) * radians(e - x) * (sin(radians(t)) - sin(radians(greatest(s, coalesce(seen, -99)))))) AS area FROM y WHERE t > greatest(s, coalesce(seen, -99)) GROUP BY 1, 2, 3)"


@query("j03_polygon_cell_union", oracle("v_rects", "SELECT code, gcol, grow, round(area / 1e6, 2) AS km2 FROM r WHERE area > 1e4", _UNITED))
def j03_union(spark, sf):
    """Overlapping rectangles of a code count once."""
    corner = lambda x, y: F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax")).alias("points")
    p = view(spark, sf, "v_rects").select("poly_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), "code", ring)
    out = polygon_cell_union(p, GridSpec(-15.0, 12.0, 0.5, 0.5, 100, 60))
    return out.filter("area > 1e4").select("code", "gcol", "grow", F.round(F.col("area") / 1e6, 2).alias("km2"))


@query("s09_union_layers", oracle("v_rects", "SELECT c AS type FROM (VALUES (3), (7), (99)) v(c) WHERE c NOT IN (SELECT code FROM v_rects)"))
def s09(spark, sf):
    r = view(spark, sf, "v_rects").select("poly_id", F.col("code").alias("type"))
    return overlay.union_layers(r.filter("poly_id < 200"), r.filter("poly_id >= 200"), spark.createDataFrame([(3,), (7,), (99,)], "type int"))[1]


@query("s10_admin_shapes", oracle("v_admin", "SELECT DISTINCT CAST(level0 AS INT) AS country, level1 AS shape, 1 AS level FROM v_admin WHERE level0 IN (1, 2, 3) UNION ALL SELECT DISTINCT CAST(level0 AS INT), CAST(level0 AS INT), 0 FROM v_admin WHERE level0 NOT IN (1, 2, 3, 9)"))
def s10(spark, sf):
    a = view(spark, sf, "v_admin")
    l0 = a.select(F.col("level0").alias("country"), F.col("level0").alias("shape")).distinct()
    l1 = a.filter("level0 <> 4").select(F.col("level0").alias("country"), F.col("level1").alias("shape")).distinct()
    pick = lambda ids: spark.createDataFrame([(i,) for i in ids], "country int")
    return overlay.select_admin_shapes(l0, l1, pick([1, 2, 3, 4, 9]), pick([9]))


@query("s13_choose_source", oracle("", "SELECT 'brand' AS dataset, 0.5e0 AS res FROM part HAVING count(*) > 0"))
def s13(spark, sf):
    p = table(spark, sf, "part")
    files = p.select("p_brand").distinct().select(F.col("p_brand").alias("crop"))
    rows = [("brand", 0.5, 0.0), ("fine", 0.25, 0.0), ("odd", 0.3, 0.0), ("coarse", 2.0, 0.0), ("narrow", 1.0, 10.0)]
    sets = spark.createDataFrame(rows, "dataset string, res double, xmin double")
    c = files.crossJoin(F.broadcast(sets)).select("dataset", "crop", "res", "xmin", F.lit(50.0).alias("xmax"), F.lit(0.0).alias("ymin"), F.lit(30.0).alias("ymax"), F.lit(True).alias("convertible"))
    return overlay.choose_source(c, GridSpec(5.0, 30.0, 1.0, 1.0, 40, 20), files.count())


# nutrients


@query("a15_weighted_mean", oracle("v_rates", "SELECT crop, year, CAST(floor(cell / 10) AS BIGINT) AS block, round(coalesce(sum(rate * weight) / nullif(sum(CASE WHEN rate IS NOT NULL THEN weight END), 0), 0), 6) AS rate FROM v_rates GROUP BY 1, 2, 3"))
def a15(spark, sf):
    r = view(spark, sf, "v_rates").withColumn("block", F.floor(F.col("cell") / 10))
    return nutrients.weighted_mean(r, ["crop", "year", "block"]).select("crop", "year", "block", F.round("rate", 6).alias("rate"))


_ASOF = "l AS (SELECT DISTINCT country, year FROM v_proxy), r AS (SELECT DISTINCT country, year AS src, country * 10 + year AS v FROM v_proxy WHERE year IN (1996, 2000)), y AS (SELECT year, arg_min(src, struct_pack(a := abs(src - year), b := src)) AS src FROM (SELECT DISTINCT year FROM l) CROSS JOIN (SELECT DISTINCT src FROM r) GROUP BY 1)"


@query("j11_asof_year", oracle("v_proxy", "SELECT l.country, l.year, y.src AS src_year, r.v FROM l JOIN y USING (year) LEFT JOIN r ON r.country = l.country AND r.src = y.src", _ASOF))
def j11(spark, sf):
    p = view(spark, sf, "v_proxy").select("country", "year").distinct()
    right = p.filter("year in (1996, 2000)").withColumn("v", F.col("country") * 10 + F.col("year"))
    return nutrients.asof_year(p, right, ["country"])


@query("j11_zero", oracle("v_proxy", "SELECT DISTINCT country, year, CASE WHEN year IN (1996, 2000) THEN country * 1e0 ELSE 0 END AS v FROM v_proxy"))
def j11_zero(spark, sf):
    p = view(spark, sf, "v_proxy").select("country", "year").distinct()
    return nutrients.asof_year(p, p.filter("year in (1996, 2000)").withColumn("v", F.col("country").cast("double")), ["country"], "zero")


_RATE = """ra AS (SELECT a.cell, level0, level1, level2, CASE WHEN a.cell % 3 = 0 OR level0 = 5 OR level1 % 7 = 0 THEN NULL ELSE a.area END AS rate, CAST(a.cell % 4 = 1 AS INT) + 1 AS border FROM v_admin a),
  {units}
  rf AS (SELECT cell, level0, level1, level2, border, coalesce(rate, m2.m, m1.m, m0.m) AS rate, CAST(CASE WHEN rate IS NOT NULL THEN 1 WHEN m2.m IS NOT NULL THEN 2 WHEN m1.m IS NOT NULL THEN 3 WHEN m0.m IS NOT NULL THEN 4 END AS INT) AS fill_level FROM ra LEFT JOIN m2 USING (level2) LEFT JOIN m1 USING (level1) LEFT JOIN m0 USING (level0))"""
_UNIT = "m{k} AS (SELECT level{k}, CASE WHEN n >= 10 OR n >= size * 0.25e0 AND n > 0 THEN med END AS m FROM (SELECT level{k}, count(*) AS size, CASE WHEN count_if(border <= 1) > 0 THEN median(CASE WHEN border <= 1 THEN rate END) ELSE median(rate) END AS med, CASE WHEN count_if(border <= 1) > 0 THEN count(CASE WHEN border <= 1 THEN rate END) ELSE count(rate) END AS n FROM ra GROUP BY 1)),"
_RATE = _RATE.format(units=" ".join(_UNIT.format(k=k) for k in (2, 1, 0)))


def _rates(spark, sf):
    a = view(spark, sf, "v_admin")
    gone = (F.col("cell") % 3 == 0) | (F.col("level0") == 5) | (F.col("level1") % 7 == 0)
    return a.select("cell", "level0", "level1", "level2", F.when(~gone, F.col("area")).alias("rate"), ((F.col("cell") % 4 == 1).cast("int") + 1).alias("border"))


@query("g05_rate_fill", oracle("v_admin", "SELECT cell, round(rate, 4) AS rate, fill_level FROM rf", _RATE))
def g05(spark, sf):
    return nutrients.rate_fill(_rates(spark, sf), ["level2", "level1", "level0"]).select("cell", F.round("rate", 4).alias("rate"), "fill_level")


@query("a19_unit_median", oracle("v_raster v_admin", "SELECT level1, med AS class, k > 1 AND abs(mo - med) > 1e-9 AS spread FROM (SELECT level1, median(class) AS med, count(DISTINCT class) AS k FROM v_raster JOIN v_admin USING (cell) GROUP BY 1) JOIN (SELECT level1, class AS mo FROM (SELECT level1, class, row_number() OVER (PARTITION BY level1 ORDER BY count(*) DESC, class) AS r FROM v_raster JOIN v_admin USING (cell) GROUP BY 1, 2) WHERE r = 1) USING (level1)"))
def a19(spark, sf):
    return nutrients.unit_median(view(spark, sf, "v_raster").join(view(spark, sf, "v_admin"), "cell"), "level1", "class")


@query("a19_group_median", oracle("", "SELECT l_returnflag AS flag, l_linestatus AS status, round(median(l_extendedprice), 4) AS median, count(l_extendedprice) AS n FROM lineitem GROUP BY ALL"))
def a19_groups(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), "l_extendedprice")
    return exact_medians(rows, ["flag", "status"], "l_extendedprice", 1_000).select("flag", "status", F.round("median", 4).alias("median"), "n")


_FALLBACK = """v AS (SELECT n_nationkey AS country, CASE WHEN n_nationkey % 3 = 1 THEN NULL ELSE n_nationkey * 1e0 END AS value FROM nation),
  mb AS (SELECT n_nationkey AS country, 1 AS lv, concat('r', CAST(n_regionkey AS VARCHAR)) AS grp, n_nationkey % 4 AS st, n_nationkey % 2 AS br FROM nation UNION ALL SELECT n_nationkey, 2, concat('c', CAST(n_regionkey % 2 AS VARCHAR)), n_nationkey % 4, n_nationkey % 2 FROM nation UNION ALL SELECT n_nationkey, 3, 'w', n_nationkey % 4, n_nationkey % 2 FROM nation),
  dn AS (SELECT * FROM v JOIN mb USING (country) WHERE value IS NOT NULL),
  hit AS (SELECT n.country, n.lv + 4 AS fl, (SELECT median(value) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp AND d.st = n.st) AS x, (SELECT count(*) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp AND d.st = n.st) AS k FROM v JOIN mb n USING (country) WHERE value IS NULL
    UNION ALL SELECT n.country, n.lv + 4.25e0, (SELECT median(value) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp AND d.br = n.br), (SELECT count(*) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp AND d.br = n.br) FROM v JOIN mb n USING (country) WHERE value IS NULL
    UNION ALL SELECT n.country, n.lv + 4.5e0, (SELECT median(value) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp), (SELECT count(*) FROM dn d WHERE d.lv = n.lv AND d.grp = n.grp) FROM v JOIN mb n USING (country) WHERE value IS NULL),
  bh AS (SELECT country, fl, x, k, row_number() OVER (PARTITION BY country ORDER BY fl) AS r FROM hit WHERE k >= 3 OR fl = 7.5e0 AND k > 0)"""


@query("g06_group_fallback", oracle("", "SELECT v.country, coalesce(value, x) AS value, CASE WHEN value IS NOT NULL THEN 0 ELSE fl END AS fill_level, CASE WHEN value IS NOT NULL THEN 1 ELSE k END AS n_sources FROM v LEFT JOIN bh ON bh.country = v.country AND r = 1", _FALLBACK))
def g06(spark, sf):
    n = table(spark, sf, "nation")
    values = n.select(F.col("n_nationkey").alias("country"), F.when(F.col("n_nationkey") % 3 != 1, F.col("n_nationkey").cast("double")).alias("value"))
    level = lambda k, g: n.select(F.col("n_nationkey").alias("country"), F.lit(k).alias("level"), g.alias("grp"), (F.col("n_nationkey") % 4).alias("status"), (F.col("n_nationkey") % 2).alias("broad"))
    members = level(1, F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))).unionByName(level(2, F.concat(F.lit("c"), (F.col("n_regionkey") % 2).cast("string")))).unionByName(level(3, F.lit("w")))
    return nutrients.group_fallback(values, members)


_STEP = "{t}{k} AS (SELECT level{k}, year, CASE WHEN n >= 3 OR n >= size * 0.25e0 AND n > 0 THEN med END AS m FROM (SELECT level{k}, year, count(*) AS size, CASE WHEN count_if(border <= 1) > 0 THEN median(CASE WHEN border <= 1 THEN {v} END) ELSE median({v}) END AS med, CASE WHEN count_if(border <= 1) > 0 THEN count(CASE WHEN border <= 1 THEN {v} END) ELSE count({v}) END AS n FROM {src} GROUP BY 1, 2))"
_FILLED = "{out} AS (SELECT {src}.*, coalesce({v}, {t}2.m, {t}1.m, {t}0.m) AS filled, CASE WHEN {v} IS NOT NULL THEN 1 WHEN {t}2.m IS NOT NULL THEN 2 WHEN {t}1.m IS NOT NULL THEN 3 WHEN {t}0.m IS NOT NULL THEN 4 END AS level FROM {src} LEFT JOIN {t}2 USING (level2, year) LEFT JOIN {t}1 USING (level1, year) LEFT JOIN {t}0 USING (level0, year))"


def _filling(t: str, v: str, src: str, out: str) -> str:
    """A pass of the hierarchical filling per year, as CTEs."""
    return ", ".join([_STEP.format(t=t, k=k, v=v, src=src) for k in (2, 1, 0)] + [_FILLED.format(t=t, v=v, src=src, out=out)])


_TREND = ("ry AS (SELECT cell, level0, level1, level2, CAST(y AS INT) AS year, CASE WHEN cell % 3 = 0 OR level0 = 5 OR level1 % 7 = 0 OR y = 2003 AND level0 % 4 = 0 THEN NULL ELSE area * (y - 1999) END AS rate, CAST(cell % 4 = 1 AS INT) + 1 AS border FROM v_admin CROSS JOIN range(2000, 2004) r(y)), "
          + _filling("p", "rate", "ry", "f1") + ", ab AS (SELECT *, max(CASE WHEN year = 2001 THEN filled END) OVER (PARTITION BY cell) AS base FROM f1), rt AS (SELECT cell, level0, level1, level2, year, border, level AS first_level, filled / nullif(base, 0) AS ratio FROM ab), " + _filling("s", "ratio", "rt", "f2"))


@query("g07_trend_fill", oracle("v_admin", "SELECT level0 AS country, year, round(coalesce(median(filled), 0), 6) AS ratio, CAST(CASE WHEN median(filled) IS NULL THEN -1 ELSE max(greatest(coalesce(first_level, 0), coalesce(level, 0))) END AS INT) AS fill_level FROM f2 GROUP BY 1, 2", _TREND))
def g07(spark, sf):
    cells = _rates(spark, sf).withColumn("year", F.explode(F.sequence(F.lit(2000), F.lit(2003))))
    cells = cells.withColumn("rate", F.when((F.col("year") == 2003) & (F.col("level0") % 4 == 0), None).otherwise(F.col("rate") * (F.col("year") - 1999)))
    return nutrients.trend_fill(cells, ["level2", "level1", "level0"], 2001).select("country", "year", F.round("ratio", 6).alias("ratio"), "fill_level")


@query("g08_apply_trend", oracle("v_admin v_proxy", "SELECT cell, year, round(area * cropland / 100, 4) AS rate FROM v_admin JOIN v_proxy ON country = level0"))
def g08(spark, sf):
    trend = view(spark, sf, "v_proxy").select("country", "year", (F.col("cropland") / 100).alias("ratio"))
    pattern = view(spark, sf, "v_admin").select("cell", F.col("level0").alias("country"), F.col("area").alias("rate"))
    return nutrients.apply_trend(pattern, trend).select("cell", "year", F.round("rate", 4).alias("rate"))


@query("g09_rebase", oracle("v_parts v_admin", "SELECT cell, round(5 * area / CASE WHEN cell % 6 > 0 AND cropland > 0 THEN cropland END, 4) AS rate, round(CASE WHEN cell % 6 > 0 AND cropland > 0 THEN 0 ELSE 5 * area END, 4) AS lost FROM v_parts JOIN v_admin USING (cell)"))
def g09(spark, sf):
    p = view(spark, sf, "v_parts").join(view(spark, sf, "v_admin").select("cell", "area"), "cell").withColumn("rate", F.lit(5.0))
    p = p.withColumn("cropland", F.when(F.col("cell") % 6 > 0, F.col("cropland")).otherwise(0.0))
    return nutrients.rebase_rate(p).select("cell", F.round("rate", 4).alias("rate"), F.round("lost", 4).alias("lost"))


@query("g10_combine", oracle("v_parts", "SELECT cell, round(CASE WHEN cell % 3 <> 0 OR cell % 4 <> 0 THEN CASE WHEN cell % 3 <> 0 THEN rainfed ELSE 0 END + CASE WHEN cell % 4 <> 0 THEN irrigated ELSE 0 END * 0.6e0 END, 4) AS rate FROM v_parts WHERE cell % 3 <> 0 OR cell % 4 <> 0"))
def g10(spark, sf):
    p = view(spark, sf, "v_parts")
    return nutrients.combine(p.filter("cell % 3 <> 0").select("cell", F.col("rainfed").alias("rate")), p.filter("cell % 4 <> 0").select("cell", F.col("irrigated").alias("rate")), ["cell"]).select("cell", F.round("rate", 4).alias("rate"))
