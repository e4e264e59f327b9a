"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], each by the median of $BENCH_RUNS runs (3); prints one
JSON line.

BENCH_LATTICE=1 adds a synthetic lattice of 5 arc minutes (9,331,200 cells) for the radius join, block sums, upstream
accumulation and first-pass disaggregation.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "w05_fill_scale_rollup", "a01_block_sum", "a07_dominant_levels", "a13_soil_assign", "a15_weighted_mean", "g01_window_fill", "g03_hier_fill", "g05_rate_fill",
    "g17_disaggregate", "g18_redistribute", "j03_polygon_cell_area", "j07_radius_join", "r02_outlets", "r04_accumulate", "r05_best_neighbour", "r06_snap_points",
]


def lattice(spark):
    """name -> a query over 4320 x 2160 cells."""
    from pyspark.sql import functions as F

    from gridprep.functions import geo
    from gridprep.functions.geo import GridSpec
    from gridprep.operators import capacity, graph, grid
    from gridprep.operators.rivers import tile_of_blocks

    spec = GridSpec(-180.0, 90.0, 1 / 12, 1 / 12, 4320, 2160)
    cells = spark.range(4320 * 2160).select(F.col("id").alias("cell"), (F.col("id") % 4320).cast("int").alias("gcol"), F.floor(F.col("id") / 4320).cast("int").alias("grow"))
    cells = cells.withColumn("lon", geo.to_lon("cell", spec)).withColumn("lat", geo.to_lat("cell", spec)).withColumn("value", F.pmod(F.xxhash64("cell"), F.lit(1000)).cast("double"))
    river = cells.select("cell", F.when(F.col("cell") % 4099 == 0, None).when(F.col("cell") % 3 == 0, F.col("cell") - F.least(F.col("cell"), F.lit(4320))).otherwise(F.col("cell") - 1).alias("next_cell"))
    totals = spark.range(250).select(F.col("id").alias("country"), F.lit(0).alias("crop"), F.lit(1e6).alias("total"))
    own = cells.select("cell", (F.floor(F.col("gcol") / 175) * 10 + F.floor(F.col("grow") / 216)).alias("country"), F.lit(0).alias("crop"), (F.col("value") / 1000).alias("pattern"), F.col("value").alias("cropland"))
    return {
        "lattice_block_sum": lambda: grid.block_agg(cells, 6, 6),
        "lattice_disaggregate": lambda: capacity.disaggregate(totals, own),
        "lattice_radius_join": lambda: graph.radius_join(cells.filter("grow between 700 and 760"), cells.filter("grow between 690 and 770").withColumnRenamed("cell", "other"), 20_000.0),
        "lattice_accumulate": lambda: graph.accumulate(graph.river_graph(river), cells.select("cell", F.col("value").alias("area")), tile=tile_of_blocks(4320)),
    }


def main() -> None:
    from gridprep.plans import QUERIES
    from gridprep.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {n: (lambda n=n: QUERIES[n](spark, sf)) for n in HEADLINE}
    if os.environ.get("BENCH_LATTICE"):
        jobs |= lattice(spark)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {}
    # a query that isn't counted pays for the session's start; of several runs the middle one counts
    jobs["w05_fill_scale_rollup"]().write.format("noop").mode("overwrite").save()
    for name, make in jobs.items():
        took = []
        for _ in range(1 if name.startswith("lattice") else runs):
            began = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        times[name] = round(median(took), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
