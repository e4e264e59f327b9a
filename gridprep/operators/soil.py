"""Dominant soil and pH of a cell, and filling of cells without soil from an expanding window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridprep.functions.geo import GridSpec, cell_area, haversine
from gridprep.operators.windows import MAX_CELLS, nearest_sources, presence
from gridprep.session import reliable_cut

#: Codes of rock, ice and dunes, and the texture class that dunes count as.
ROCK, ICE, DUNES, SAND = "RK", "GG", "DS", 1


def soil_assign(overlay: DataFrame, attributes: DataFrame, rock_only_alone: bool = False) -> DataFrame:
    """cell, class, mu, ph, ph_source from mapping units' areas in a cell and the soils of each unit.

    ``overlay``: cell, mu, area; ``attributes``: mu, soil_id, texture, sym, share (0 to 1), ph. The class is a texture, or
    100 for rock and 101 for ice; dunes are sand. The largest class wins, then the largest unit in it. pH: weighted by area
    over the soils of the class in that unit (source 1), else of the class (2), else of the unit (3), else 7 for rock and
    ice (4). Ties: lowest class and unit. With ``rock_only_alone`` rock and ice count only where there is nothing else.
    """
    kind = F.when(F.col("sym") == ROCK, 100).when(F.col("sym") == ICE, 101).when(F.col("sym") == DUNES, SAND).otherwise(F.col("texture"))
    pieces = overlay.join(attributes, "mu").withColumn("class", kind).withColumn("w", F.col("area") * F.col("share")).filter("class is not null and w > 0")
    known = F.when(F.col("ph").isNotNull(), F.col("w"))
    fine = pieces.groupBy("cell", "class", "mu").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("ph")).alias("wp"), F.sum(known).alias("wk"))
    w = Window.partitionBy("cell", "class")
    fine = fine.withColumn("class_w", F.sum("w").over(w)).withColumn("class_wp", F.sum("wp").over(w)).withColumn("class_wk", F.sum("wk").over(w))
    u = Window.partitionBy("cell", "mu")
    fine = fine.withColumn("unit_wp", F.sum("wp").over(u)).withColumn("unit_wk", F.sum("wk").over(u))
    last = (F.col("class") >= 100) if rock_only_alone else F.lit(False)
    best = fine.groupBy("cell").agg(F.min_by(F.struct("class", "mu", "wp", "wk", "class_wp", "class_wk", "unit_wp", "unit_wk"), F.struct(last.alias("l"), (-F.round("class_w", 6)).alias("a"), "class", (-F.round("w", 6)).alias("b"), "mu")).alias("s")).select("cell", "s.*")
    mean = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    steps = [mean("wp", "wk"), mean("class_wp", "class_wk"), mean("unit_wp", "unit_wk"), F.when(F.col("class") >= 100, F.lit(7.0))]
    source = F.coalesce(*(F.when(s.isNotNull(), F.lit(k)) for k, s in enumerate(steps, 1)))
    return best.select("cell", "class", "mu", F.coalesce(*steps).alias("ph"), source.alias("ph_source"))


def window_fill(sources: DataFrame, missing: DataFrame, spec: GridSpec, power: float = 2.0, max_cells: int | None = None, max_lattice: int = MAX_CELLS) -> DataFrame:
    """(cell, source, weight, window, distance) for each missing cell: the valid cells of the smallest square window that
    has any, weighted by area / distance^power.

    ``sources``: cell, gcol, grow; ``missing``: cell, gcol, grow. The window (cells to each side) is read from a bit map
    of the lattice, and one join by place brings the sources; longitudes wrap on a global lattice. It grows until a source
    is inside or it spans the lattice, or up to ``max_cells``. A cell without any source inside has one row, with a null
    source, weight, window and distance. A lattice of more than ``max_lattice`` cells is searched in rounds instead.
    """
    widest = max(spec.ncol, spec.nrow)
    limit = widest if max_cells is None else min(max_cells, widest)
    have = presence(sources, spec.ncol, spec.wraps, max_lattice)
    if have is None:
        found = _searched_in_rounds(sources, missing, spec, limit)
    else:
        at = sources.select(F.col("cell").alias("source"), F.col("gcol").alias("sc"), F.col("grow").alias("sr"))
        found = nearest_sources(missing, have, limit).join(at, ["sc", "sr"], "left")
    at = lambda c: F.lit(spec.xmin) + (F.col(c) + 0.5) * spec.res_lon
    lat = lambda r: F.lit(spec.ymax) - (F.col(r) + 0.5) * spec.res_lat
    d = haversine(at("gcol"), lat("grow"), at("sc"), lat("sr"))
    weight = cell_area(lat("sr"), spec.res_lon, spec.res_lat) / F.pow(d, F.lit(power))
    return found.select("cell", "source", weight.alias("weight"), "window", d.alias("distance"))


def _searched_in_rounds(sources: DataFrame, missing: DataFrame, spec: GridSpec, limit: int) -> DataFrame:
    """cell, gcol, grow, source, sc, sr, window of each missing cell: the window doubles from round to round for the cells
    that found nothing, so bucket sizes stay near the window's."""
    s = sources.select(F.col("cell").alias("source"), F.col("gcol").alias("sc"), F.col("grow").alias("sr"))
    todo, found, k = reliable_cut(missing.select("cell", "gcol", "grow")), None, 1
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    while k <= limit and not todo.isEmpty():
        n = -(-spec.ncol // k)
        bucketed = s.withColumn("bx", F.floor(F.col("sc") / k)).withColumn("by", F.floor(F.col("sr") / k))
        # the last bucket of a wrapping lattice may be narrow: then one more to the west is needed
        side = (-2, -1, 0, 1, 2) if spec.wraps and spec.ncol % k else (-1, 0, 1)
        shift = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in side for j in (-1, 0, 1)))) if len(side) > 3 else steps
        near = todo.withColumn("s", shift)
        bx = F.floor(F.col("gcol") / k) + F.col("s.i")
        near = near.withColumn("bx", F.pmod(bx, F.lit(n)) if spec.wraps else bx).withColumn("by", F.floor(F.col("grow") / k) + F.col("s.j")).drop("s").distinct()
        gap = F.abs(F.col("gcol") - F.col("sc"))
        across = F.least(gap, F.lit(spec.ncol) - gap) if spec.wraps else gap
        met = near.join(bucketed, ["bx", "by"]).withColumn("reach", F.greatest(across, F.abs(F.col("grow") - F.col("sr")))).filter(F.col("reach") <= k)
        nearest = F.min("reach").over(Window.partitionBy("cell"))
        hit = reliable_cut(met.withColumn("window", nearest).filter("reach <= window").select("cell", "gcol", "grow", "source", "sc", "sr", "window"))
        found = hit if found is None else found.unionByName(hit)
        todo = reliable_cut(todo.join(hit.select("cell").distinct(), "cell", "left_anti"))
        k = limit if k < limit < 2 * k else 2 * k
    none = todo.select("cell", "gcol", "grow", *(F.lit(None).cast("long").alias(c) for c in ("source", "sc", "sr", "window")))
    return none if found is None else found.unionByName(none)
