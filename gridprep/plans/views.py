"""Inputs of the operators' shapes, derived from the base tables; the same text serves Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()

VIEWS = {
    "v_grid": """SELECT c_custkey AS cell, CAST(c_custkey % 50 AS INT) AS gcol, CAST(floor(c_custkey / 50.0) AS INT) AS grow,
  CASE WHEN c_custkey % 50 < 25 THEN 167.75e0 + 0.5e0 * (c_custkey % 50) ELSE -192.25e0 + 0.5e0 * (c_custkey % 50) END AS lon,
  74.75e0 - 0.5e0 * floor(c_custkey / 50.0) AS lat FROM {customer}""",
    "v_raster": """SELECT c_custkey AS cell, CAST(c_custkey % 50 AS INT) AS gcol, CAST(floor(c_custkey / 50.0) AS INT) AS grow,
  CASE WHEN c_custkey % 11 = 0 OR floor(c_custkey / 50.0) % 8 < 2 AND c_custkey % 50 < 4 THEN NULL ELSE c_acctbal END AS value,
  CAST((c_custkey * 7) % 5 AS INT) AS class FROM {customer}""",
    "v_admin": """SELECT c_custkey AS cell, c_nationkey AS level0, c_nationkey * 10 + CAST(length(c_mktsegment) % 3 AS INT) AS level1,
  (c_nationkey * 10 + CAST(length(c_mktsegment) % 3 AS INT)) * 10 + CAST(c_custkey % 4 AS INT) AS level2, abs(c_acctbal) + 1 AS area FROM {customer}""",
    "v_river": """SELECT c_custkey AS cell, CASE WHEN c_custkey % 97 = 0 THEN -1 WHEN c_custkey % 3 = 0 AND c_custkey >= 50 THEN c_custkey - 50
  WHEN c_custkey % 50 > 0 THEN c_custkey - 1 WHEN c_custkey >= 50 THEN c_custkey - 50 ELSE -1 END AS next_cell, abs(c_acctbal) + 1 AS area FROM {customer}""",
    "v_series": """SELECT country, crop, year, CASE WHEN (country * 31 + year * 7 + length(crop)) % 3 = 0 OR year = 1995 AND country % 4 = 0
    OR year = 2001 AND country % 4 = 1 THEN NULL ELSE ha END AS ha
FROM (SELECT s_nationkey AS country, p_type AS crop, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(l_quantity) AS DOUBLE) AS ha
  FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3) t""",
    "v_proxy": """SELECT country, year, CASE WHEN (country + year) % 9 = 0 THEN NULL WHEN (country * year) % 13 = 0 THEN 0e0 ELSE cropland END AS cropland
FROM (SELECT s_nationkey AS country, CAST(year(l_shipdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS cropland
  FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey GROUP BY 1, 2) t""",
    "v_groups": """SELECT n_nationkey AS country, concat('R', CAST(n_regionkey AS VARCHAR(9))) AS grp FROM {nation}
UNION ALL SELECT n_nationkey, 'World' FROM {nation} UNION ALL SELECT n_nationkey, 'Even' FROM {nation} WHERE n_nationkey % 2 = 0""",
    "v_soil": """SELECT p_partkey AS soil_id, CAST(floor(p_partkey / 10.0) AS INT) AS mu, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_partkey % 12 AS INT) + 1 END AS texture,
  CASE WHEN p_partkey % 17 = 0 THEN 'RK' WHEN p_partkey % 23 = 0 THEN 'DS' ELSE 'XX' END AS sym,
  p_size * 1e0 / sum(p_size) OVER (PARTITION BY floor(p_partkey / 10.0)) AS share,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 4 + (p_partkey % 40) / 10e0 END AS ph FROM {part}""",
    "v_points": """SELECT s_suppkey AS point_id, CASE WHEN s_suppkey % 50 < 25 THEN 167.8e0 + 0.5e0 * (s_suppkey % 50) ELSE -192.2e0 + 0.5e0 * (s_suppkey % 50) END AS lon,
  74.7e0 - 0.5e0 * (s_suppkey % 3) AS lat, abs(s_acctbal) * 5 AS catch_area, abs(s_acctbal) AS capacity,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE CAST(1950 + s_suppkey % 60 AS INT) END AS year,
  CASE WHEN s_suppkey % 10 = 0 THEN 'Planned' WHEN s_suppkey % 10 = 1 THEN 'Modified' ELSE NULL END AS timeline FROM {supplier}""",
    "v_rects": """SELECT p_partkey AS poly_id, CAST(p_partkey % 25 AS INT) AS code, -12e0 + 0.6e0 * (p_partkey % 40) AS xmin, -12e0 + 0.6e0 * (p_partkey % 40) + 0.07e0 * p_size AS xmax,
  -9e0 + 0.45e0 * (p_partkey % 37) AS ymin, -9e0 + 0.45e0 * (p_partkey % 37) + 0.05e0 * p_size AS ymax FROM {part}""",
    "v_parts": """SELECT c_custkey AS cell, c_nationkey AS country, abs(c_acctbal) AS cropland,
  abs(c_acctbal) * (c_custkey % 7 + (CASE WHEN c_custkey % 7 = 6 AND c_custkey % 4 = 0 THEN 1 ELSE 0 END)) / 6e0 AS rainfed,
  abs(c_acctbal) * (6 - c_custkey % 7 + (CASE WHEN c_custkey % 5 = 0 AND c_custkey % 7 > 0 THEN 1 WHEN c_custkey % 5 = 1 AND c_custkey % 7 < 6 THEN -1 ELSE 0 END)) / 6e0 AS irrigated,
  CAST(c_custkey % 4 AS INT) AS suit_rf, CAST(least(3, c_custkey % 4 + 1) AS INT) AS suit_ir FROM {customer}""",
    "v_rates": """SELECT l_orderkey AS id, l_suppkey AS cell, p_type AS crop, CAST(year(l_shipdate) AS INT) AS year,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount * 100 END AS rate, CASE WHEN l_quantity < 5 THEN 0e0 ELSE l_quantity END AS weight
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "v_lifetime": """SELECT n_nationkey AS country, CAST(CASE WHEN n_nationkey IN (4, 5) THEN 1998 END AS INT) AS start_year,
  CAST(CASE WHEN n_nationkey = 3 THEN 1997 END AS INT) AS end_year, CAST(CASE WHEN n_nationkey IN (4, 5) THEN 3 END AS INT) AS parent FROM {nation}""",
    "v_slices": """SELECT o_custkey AS cell, CAST(year(o_orderdate) AS INT) AS year, sum(o_totalprice) AS value
FROM {orders} WHERE year(o_orderdate) IN (1995, 1997, 2000) GROUP BY 1, 2""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame."""
    used = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
    return spark.sql(VIEWS[name], **{t: table(spark, sf_dir, t) for t in used})


def oracle(views: str, select: str, ctes: str = "") -> str:
    """SQL for DuckDB: the named views, further CTEs, and the final select."""
    parts = [f"{v} AS ({VIEWS[v].format(**{t: t for t in TABLES})})" for v in views.split()]
    if ctes:
        parts.append(ctes)
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + select
