"""River networks and proximity: outlets, closures, accumulation, radius joins, best neighbours, snapping of points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridprep.functions.geo import EARTH_RADIUS, haversine
from gridprep.operators.rivers import accumulate, closure, labelled, outlets, tree_labels, unrelated  # noqa: F401
from gridprep.session import reliable_cut

#: Rows of a side that a bucket of the radius join holds, about, before it is cut into parts.
DENSE = 20_000
#: Pairs that a task of the radius join compares, about, and its tasks at most.
COMPARED, TASKS = 2_000_000, 20_000


def river_graph(df: DataFrame) -> DataFrame:
    """cell, next_cell: negative and unknown next cells are outlets (null)."""
    known = df.select(F.col("cell").alias("next_cell")).distinct().withColumn("__known", F.lit(True))
    # a next cell outside the grid ends the river there
    out = df.select("cell", F.when(F.col("next_cell") >= 0, F.col("next_cell")).alias("next_cell")).join(known, "next_cell", "left")
    return out.select("cell", F.when(F.col("__known"), F.col("next_cell")).alias("next_cell"))


def check_river(df: DataFrame) -> DataFrame:
    """cell, problem: what is wrong with a network of cell and next_cell: repeated (a cell with several rows), outside (a
    next cell that isn't a cell), itself, or cycle (a cell whose way down never ends). Negative next cells are outlets.

    Pointers double for as many rounds as the number of cells has binary digits; who then isn't at an outlet, is on a
    cycle or drains into one.
    """
    repeated = df.groupBy("cell").count().filter("count > 1").select("cell", F.lit("repeated").alias("problem"))
    cells = df.select(F.col("cell").alias("next_cell")).distinct()
    outside = df.filter("next_cell >= 0").join(cells, "next_cell", "left_anti").select("cell", F.lit("outside").alias("problem"))
    itself = df.filter("next_cell = cell").select("cell", F.lit("itself").alias("problem"))
    jump = reliable_cut(river_graph(df).filter("next_cell is not null and next_cell <> cell").select("cell", F.col("next_cell").alias("to")).dropDuplicates(["cell"]))
    for _ in range(max(1, jump.count()).bit_length()):
        jump = _doubled(jump)
    return repeated.unionByName(outside).unionByName(itself).unionByName(jump.select("cell", F.lit("cycle").alias("problem"))).distinct()


def _doubled(jump: DataFrame) -> DataFrame:
    """Twice as many steps; cells whose way ends before have no row."""
    return reliable_cut(jump.join(jump.select(F.col("cell").alias("to"), F.col("to").alias("to2")), "to").select("cell", F.col("to2").alias("to")))


def _dealt(left: DataFrame, right: DataFrame, left_id: str, right_id: str, dense: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with parts (i, j) of their buckets (b, k): a left row is in one i and every j, a right row in one j and every
    i. Only buckets with more than ``dense`` rows of a side have several parts of it. Both are dealt by bucket and part into as
    many tasks as their comparisons need: small tables make many pairs."""
    counts = lambda df, n: df.groupBy("b", "k").agg(F.count(F.lit(1)).alias(n))
    met = reliable_cut(counts(left, "l").join(counts(right, "r").hint("merge"), ["b", "k"]))
    work = met.agg(F.sum(F.col("l").cast("double") * F.col("r"))).first()[0] or 0
    tasks = min(TASKS, int(work // COMPARED) + 1)
    deal = lambda df: df.repartition(tasks, "b", "k", "i", "j")
    parts = lambda c: F.ceil(F.col(c) / dense).cast("int")
    crowded = met.filter((F.col("l") > dense) | (F.col("r") > dense)).select("b", "k", parts("l").alias("ni"), parts("r").alias("nj"))
    if crowded.isEmpty():
        # always 0, but no literal: by literals the join would deal its sides anew, into fewer tasks
        return tuple(deal(df.withColumn("i", F.pmod("k", F.lit(1)).cast("int")).withColumn("j", F.col("i"))) for df in (left, right))

    def spread(df: DataFrame, own: str, key: str, others: str) -> DataFrame:
        df = df.join(crowded, ["b", "k"], "left").fillna(1, ["ni", "nj"])
        df = df.withColumn(own, F.pmod(F.xxhash64(key), F.col(f"n{own}")).cast("int"))
        return df.withColumn(others, F.explode(F.sequence(F.lit(0), F.col(f"n{others}") - 1))).drop("ni", "nj")

    return deal(spread(left, "i", left_id, "j")), deal(spread(right, "j", right_id, "i"))


def radius_join(left: DataFrame, right: DataFrame, radius: float, left_id: str = "cell", right_id: str = "other", dense: int = DENSE, left_more: Sequence[str] = (), right_more: Sequence[str] = ()) -> DataFrame:
    """(left_id, right_id, distance): pairs within ``radius`` metres, across the 180-degree line as well. The columns
    ``left_more`` and ``right_more`` of the sides come along after these, which saves joins of the pairs.

    Both sides fall into latitude bands a radius high, and into longitude buckets a radius wide at the band's edge
    nearer to a pole; the left side goes to its own and the neighbouring buckets, so each pair meets once. Buckets with
    more than ``dense`` rows of a side are cut into parts by counts, so that a crowd is compared in many tasks.
    """
    height = radius / EARTH_RADIUS * 180 / 3.141592653589793
    band = lambda lat: F.floor((F.col(lat) + 90) / height)

    def buckets(b):
        # widest |lat| of the band; at the poles one bucket holds the whole circle
        edge = F.least(F.greatest(F.abs(b * height - 90), F.abs((b + 1) * height - 90)), F.lit(90.0))
        narrow = F.cos(F.radians(edge))
        width = F.lit(height) / F.when(narrow > 1e-6, narrow)
        return F.greatest(F.floor(F.lit(360.0) / F.coalesce(width * 1.01, F.lit(400.0))), F.lit(1)).cast("long")

    place = lambda lon, n: F.least(F.floor(F.pmod(F.col(lon) + 180, F.lit(360.0)) * n / 360), n - 1)
    r = right.select(F.col(right_id), F.col("lon").alias("rlon"), F.col("lat").alias("rlat"), *right_more, band("lat").alias("b")).withColumn("n", buckets(F.col("b")))
    r = r.withColumn("k", place("rlon", F.col("n"))).drop("n")
    bands = F.explode(F.array(band("lat") - 1, band("lat"), band("lat") + 1))
    x = left.select(F.col(left_id), F.col("lon").alias("llon"), F.col("lat").alias("llat"), *left_more, bands.alias("b")).withColumn("n", buckets(F.col("b")))
    near = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(place("llon", F.col("n")) + d, F.col("n"))))
    x = x.withColumn("k", F.explode(near)).drop("n")
    d = haversine("llon", "llat", "rlon", "rlat")
    x, r = _dealt(x, r, left_id, right_id, dense)
    # never a broadcast of a side: what a task holds would grow with it
    return x.join(r.hint("merge"), ["b", "k", "i", "j"]).select(left_id, right_id, d.alias("distance"), *left_more, *right_more).filter(F.col("distance") <= radius)


def exclude_related(pairs: DataFrame, related: DataFrame) -> DataFrame:
    """Pairs (cell, other) of which neither is downstream of the other; ``related``: cell, down_cell."""
    down = related.select("cell", F.col("down_cell").alias("other"))
    return pairs.join(down, ["cell", "other"], "left_anti").join(down.select(F.col("other").alias("cell"), F.col("cell").alias("other")), ["cell", "other"], "left_anti")


def best_neighbour(grid: DataFrame, graph: DataFrame, upstream: DataFrame | None, candidates: DataFrame, power: float = 2.0, labels: DataFrame | None = None) -> DataFrame:
    """cell, best: the candidate with the highest upstream area / distance^power that is on no common river with the cell.

    Ties: the nearer, then the smaller id; a cell without candidates is its own. ``candidates``: cell, other, distance;
    ``upstream``: cell, area; or none, and ``labels`` of tree_labels with the areas as their values. Candidates may bring
    labels along (see unrelated); then the pairs meet no other table.
    """
    labels = tree_labels(graph) if labels is None else labels
    free = unrelated(labelled(candidates.filter("cell <> other"), labels), graph, labels=labels)
    if upstream is None:
        scored = free.filter("__other is not null").withColumn("up", F.col("__other.value"))
    else:
        scored = free.join(upstream.select(F.col("cell").alias("other"), F.col("area").alias("up")).hint("merge"), "other")
    scored = scored.withColumn("score", F.col("up") / F.pow("distance", F.lit(power)))
    best = scored.groupBy("cell").agg(F.min_by("other", F.struct((-F.col("score")).alias("a"), "distance", "other")).alias("best"))
    return grid.select("cell").join(best.hint("merge"), "cell", "left").select("cell", F.coalesce("best", "cell").alias("best"))


def undominated(candidates: DataFrame) -> DataFrame:
    """Candidates (point_id, cell, distance, deviation, ...) that may be best for some penalties that aren't negative.

    One goes if another on its side of zero deviation is no farther and deviates no more, and comes first where all costs
    are equal. That is a running minimum by distance; of a point without deviations the nearest stays.
    """
    size = F.coalesce(F.abs("deviation"), F.lit(0.0))
    before = Window.partitionBy("point_id", F.coalesce(F.col("deviation") > 0, F.lit(False))).orderBy("distance", "cell").rowsBetween(Window.unboundedPreceding, -1)
    least = candidates.withColumn("__least", F.min(size).over(before))
    return least.filter(F.col("__least").isNull() | (size < F.col("__least"))).drop("__least")


def snap_points(points: DataFrame, grid: DataFrame, params: DataFrame, max_degrees: float, max_distance: float, manual: DataFrame | None = None) -> DataFrame:
    """(params, point_id, cell, distance, deviation): the best cell for each point under every pair of penalties at once.

    Weight 1 / distance^d * 1 / |deviation|^e, with e scaled by ``over`` where the cell's catchment is larger than the
    point's; compared as logarithms, so a distance or deviation of 0 wins. Candidates lie within ``max_degrees`` of the
    point in both axes and within ``max_distance``; ties: the nearer, then the smaller cell. ``params`` (set_id, d, e,
    over) is a small table; ``manual`` (point_id, cell) bypasses the search.
    """
    size = max_degrees
    searched = points if manual is None else points.join(manual.select("point_id"), "point_id", "left_anti")
    g = grid.select("cell", F.col("lon").alias("glon"), F.col("lat").alias("glat"), F.col("area").alias("up"))
    g = g.withColumn("bx", F.floor(F.pmod(F.col("glon") + 180, F.lit(360.0)) / size)).withColumn("by", F.floor((F.col("glat") + 90) / size))
    n = -int(-360 // size)
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    p = searched.select("point_id", F.col("lon").alias("plon"), F.col("lat").alias("plat"), "catch_area", steps.alias("s"))
    p = p.withColumn("bx", F.pmod(F.floor(F.pmod(F.col("plon") + 180, F.lit(360.0)) / size) + F.col("s.i"), F.lit(n))).withColumn("by", F.floor((F.col("plat") + 90) / size) + F.col("s.j")).drop("s")
    dlon = F.abs(F.pmod(F.col("plon") - F.col("glon") + 180, F.lit(360.0)) - 180)
    near = p.join(g, ["bx", "by"]).filter((dlon <= size) & (F.abs(F.col("plat") - F.col("glat")) <= size))
    near = near.withColumn("distance", haversine("plon", "plat", "glon", "glat")).filter(F.col("distance") <= max_distance)
    near = near.dropDuplicates(["point_id", "cell"])
    near = near.withColumn("deviation", (F.col("up") - F.col("catch_area")) / F.when(F.col("catch_area") != 0, F.col("catch_area")))
    if params.filter("d < 0 or e < 0 or over < 0").isEmpty():
        near = undominated(near)
    # every pair of penalties for every candidate left; the parameter table is the caller's handful of rows
    swept = near.crossJoin(F.broadcast(params))
    safe_log = lambda x: F.when(x > 0, F.log(x)).otherwise(F.lit(-1e9))
    e = F.when(F.col("deviation") > 0, F.col("e") * F.col("over")).otherwise(F.col("e"))
    cost = F.round(F.col("d") * safe_log(F.col("distance")) + e * safe_log(F.abs("deviation")), 9)
    best = swept.withColumn("cost", cost).groupBy("set_id", "point_id").agg(F.min_by(F.struct("cell", "distance", "deviation"), F.struct("cost", "distance", "cell")).alias("b"))
    out = best.select("set_id", "point_id", "b.cell", "b.distance", "b.deviation")
    if manual is not None:
        own = manual.join(points, "point_id").join(grid.select("cell", F.col("lon").alias("glon"), F.col("lat").alias("glat"), F.col("area").alias("up")), "cell")
        own = own.select("point_id", "cell", haversine("lon", "lat", "glon", "glat").alias("distance"), ((F.col("up") - F.col("catch_area")) / F.when(F.col("catch_area") != 0, F.col("catch_area"))).alias("deviation"))
        out = out.unionByName(own.crossJoin(F.broadcast(params.select("set_id"))).select(*out.columns))
    return out


def directions_to_graph(directions: DataFrame, codes: DataFrame, grid: DataFrame, ncol: int, wraps: bool = False) -> DataFrame:
    """cell, next_cell (null at an outlet), distance in m, from a raster of flow directions.

    ``directions``: gcol, grow, code; ``codes``: code, dcol, drow, a small table; ``grid``: cell, gcol, grow, lon, lat.
    """
    d = grid.join(directions.select("gcol", "grow", "code"), ["gcol", "grow"], "left").join(codes, "code", "left")
    col = F.col("gcol") + F.col("dcol")
    d = d.select("cell", "lon", "lat", (F.pmod(col, F.lit(ncol)) if wraps else col).alias("gcol"), (F.col("grow") + F.col("drow")).alias("grow"))
    to = grid.select(F.col("cell").alias("next_cell"), "gcol", "grow", F.col("lon").alias("nlon"), F.col("lat").alias("nlat"))
    out = d.join(to, ["gcol", "grow"], "left")
    own = F.col("next_cell") == F.col("cell")
    return out.select("cell", F.when(~own, F.col("next_cell")).alias("next_cell"), F.when(~own, haversine("lon", "lat", "nlon", "nlat")).alias("distance"))


def merge_dams(dams: DataFrame, key: str = "cell") -> DataFrame:
    """Records of a cell as one: sums of capacity and area, height of the largest, irrigation if any, the purpose with the
    most capacity (ties: lowest code), and the year in which half of the capacity with a year is reached.

    ``dams``: cell, dam_id, capacity, area, height, year, purpose, irrigation.
    """
    w = Window.partitionBy(key).orderBy("year").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    dated = dams.filter("year is not null").withColumn("upto", F.sum("capacity").over(w)).withColumn("all", F.sum("capacity").over(Window.partitionBy(key)))
    year = dated.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("upto") >= F.col("all") / 2, F.col("year"))), F.min("year")).alias("year"))
    by_use = dams.groupBy(key, "purpose").agg(F.sum("capacity").alias("c"))
    use = by_use.groupBy(key).agg(F.min_by("purpose", F.struct((-F.col("c")).alias("a"), "purpose")).alias("purpose"))
    facts = dams.groupBy(key).agg(F.sum("capacity").alias("capacity"), F.sum("area").alias("area"), F.min_by("height", F.struct((-F.col("capacity")).alias("a"), "dam_id")).alias("height"), F.bool_or("irrigation").alias("irrigation"), F.count(F.lit(1)).alias("n"))
    return facts.join(use, key).join(year, key, "left")
