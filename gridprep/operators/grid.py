"""Grid algebra: blocks, modes, overlays, lookups, neighbours, regridding, dominant classes, fractions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.functions.geo import GridSpec

Keys = Sequence[str]


def _block(fx: int, fy: int) -> list[Column]:
    return [F.floor(F.col("gcol") / fx).cast("int").alias("bcol"), F.floor(F.col("grow") / fy).cast("int").alias("brow")]


def check_factor(spec: GridSpec, fx: int, fy: int) -> None:
    """Blocks must tile the lattice and be larger than a cell in one axis at least."""
    if fx < 1 or fy < 1 or fx * fy < 2 or spec.ncol % fx or spec.nrow % fy:
        raise ValueError(f"blocks of {fx} x {fy} don't tile {spec.ncol} x {spec.nrow} cells")


def block_agg(df: DataFrame, fx: int, fy: int, fun: str | Callable[[Column], Column] = "sum", values: Keys = ("value",), layers: Keys = ()) -> DataFrame:
    """Blocks of fx x fy cells; nulls don't count, a block of nulls is null. ``fun``: a name or a Column -> Column."""
    make = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}[fun] if isinstance(fun, str) else fun
    return df.groupBy(*_block(fx, fy), *layers).agg(*(make(F.col(v)).alias(v) for v in values))


def block_mode(df: DataFrame, fx: int, fy: int, value: str = "class", ties: str = "lowest") -> DataFrame:
    """The most frequent value of each block. Ties: lowest, highest, first (by cell) or random (by hash, repeatable)."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*_block(fx, fy), value).agg(F.count(F.lit(1)).alias("n"), F.min("cell").alias("at"))
    tie = {"lowest": -F.col(value), "highest": F.col(value), "first": -F.col("at"), "random": F.xxhash64("bcol", "brow", value)}[ties]
    return counted.groupBy("bcol", "brow").agg(F.max_by(value, F.struct("n", tie.alias("t"))).alias(value))


def block_median(df: DataFrame, fx: int, fy: int, exact: bool = True) -> DataFrame:
    """Median and mean of the points of a block; the approximate median takes bounded memory."""
    median = F.median("value") if exact else F.percentile_approx("value", 0.5, 10_000)
    return df.groupBy(*_block(fx, fy)).agg(median.alias("median"), F.avg("value").alias("mean"), F.count("value").alias("n"))


def extract(grid: DataFrame, raster: DataFrame, value: str = "value", default: float | None = None) -> DataFrame:
    """The raster's value at each grid cell (gcol, grow); the default where there is none."""
    out = grid.join(raster.select("gcol", "grow", value), ["gcol", "grow"], "left")
    return out if default is None else out.withColumn(value, F.coalesce(value, F.lit(default)))


def overlay(fine: DataFrame, coarse: DataFrame, fx: int, fy: int) -> DataFrame:
    """Fine cells with their coarse cell's columns (bcol, brow, ...)."""
    return fine.select("*", *_block(fx, fy)).join(coarse, ["bcol", "brow"])


def adjacent(grid: DataFrame, ncol: int, wraps: bool = False) -> DataFrame:
    """(cell, other): up to eight neighbours that are in the grid; columns wrap around the globe if ``wraps``."""
    steps = F.explode(F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy)))
    moved = grid.select("cell", "gcol", "grow", steps.alias("s"))
    col = F.col("gcol") + F.col("s.dx")
    moved = moved.select("cell", (F.pmod(col, F.lit(ncol)) if wraps else col).alias("gcol"), (F.col("grow") + F.col("s.dy")).alias("grow"))
    return moved.join(grid.select(F.col("cell").alias("other"), "gcol", "grow"), ["gcol", "grow"]).select("cell", "other")


def regrid(source: DataFrame, spec: GridSpec, target: DataFrame, method: str = "bilinear", keep: str | None = None) -> DataFrame:
    """Source values (gcol, grow, value) at the target's lon, lat: nearest, bilinear (4) or bicubic (16 neighbours).

    Missing neighbours leave the weights of the others; ``keep`` names a target column whose own values stay.
    """
    x, y = (F.col("lon") - spec.xmin) / spec.res_lon - 0.5, (F.lit(spec.ymax) - F.col("lat")) / spec.res_lat - 0.5
    points = target.select("cell", F.pmod(x, F.lit(360.0 / spec.res_lon)).alias("x") if spec.wraps else x.alias("x"), y.alias("y"))
    if method == "nearest":
        near = points.select("cell", F.floor(F.col("x") + 0.5).alias("gcol"), F.floor(F.col("y") + 0.5).alias("grow"), F.lit(1.0).alias("w"))
    else:
        offsets = (0, 1) if method == "bilinear" else (-1, 0, 1, 2)

        def weight(d: Column) -> Column:
            d = F.abs(d)
            if method == "bilinear":
                return F.greatest(1 - d, F.lit(0.0))
            # Catmull-Rom's cubic
            return F.when(d <= 1, 1.5 * d * d * d - 2.5 * d * d + 1).when(d < 2, -0.5 * d * d * d + 2.5 * d * d - 4 * d + 2).otherwise(0.0)

        steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in offsets for j in offsets)))
        near = points.withColumn("s", steps).withColumn("gcol", F.floor("x") + F.col("s.i")).withColumn("grow", F.floor("y") + F.col("s.j"))
        near = near.select("cell", "gcol", "grow", (weight(F.col("x") - F.col("gcol")) * weight(F.col("y") - F.col("grow"))).alias("w")).filter("w <> 0")
    if spec.wraps:
        near = near.withColumn("gcol", F.pmod("gcol", F.lit(spec.ncol)))
    joined = near.join(source.select("gcol", "grow", "value").filter("value is not null"), ["gcol", "grow"])
    total = F.sum("w")
    made = joined.groupBy("cell").agg((F.sum(F.col("w") * F.col("value")) / F.when(F.abs(total) > 1e-12, total)).alias("value"))
    out = target.select("cell", *([F.col(keep).alias("__own")] if keep else [])).join(made, "cell", "left")
    return out.withColumn("value", F.coalesce("__own", "value")).drop("__own") if keep else out


def dominant(df: DataFrame, key: str, code: str, area: str, low_priority: Sequence = ()) -> DataFrame:
    """The code with the largest area in each cell; the low-priority ones only where there is nothing else; ties: lowest."""
    low = F.col(code).isin(list(low_priority)) if low_priority else F.lit(False)
    sums = df.groupBy(key, code).agg(F.sum(area).alias("__area"))
    return sums.groupBy(key).agg(F.min_by(code, F.struct(low.alias("l"), (-F.col("__area")).alias("a"), F.col(code).alias("c"))).alias(code), F.sum("__area").alias(area))


def dominant_levels(df: DataFrame, key: str, levels: Keys, area: str) -> DataFrame:
    """Each cell's dominant country, then the dominant region inside it, then the district inside that; null where a level is missing."""
    out = None
    for k, level in enumerate(levels):
        inside = df if out is None else df.join(out, [key, *levels[:k]], "left_semi")
        best = dominant(inside.filter(F.col(level).isNotNull()), key, level, area).select(key, level)
        if out is None:
            out = best
        else:
            out = out.join(best, key, "left")
    return out


def count_distinct(df: DataFrame, key: str, code: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(code).alias("n"))


def area_fraction(pieces: DataFrame, key: str, piece: str, area: str) -> DataFrame:
    """Share of each cell's area that its pieces cover, cut to 1; above 1.001 is an error in the pieces."""
    f = pieces.groupBy(key).agg((F.sum(piece) / F.when(F.max(area) > 0, F.max(area))).alias("fraction"))
    bad = F.raise_error(F.concat(F.lit("pieces cover more than the cell "), F.col(key).cast("string"))).cast("double")
    return f.withColumn("fraction", F.when(F.col("fraction") > 1.001, bad).otherwise(F.least("fraction", F.lit(1.0))))


def class_fraction(df: DataFrame, classes: dict[str, int], fx: int, fy: int, area: str = "area") -> DataFrame:
    """Share of each block's area in each named class, and in all of them together."""
    total = F.sum(area)
    cols = {n: F.sum(F.when(F.col("class") == c, F.col(area)).otherwise(0.0)) for n, c in classes.items()}
    every = F.sum(F.when(F.col("class").isin(list(classes.values())), F.col(area)).otherwise(0.0))
    return df.groupBy(*_block(fx, fy)).agg(*((c / total).alias(n) for n, c in cols.items()), (every / total).alias("all"))


def time_max(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def match_resolution(admin: DataFrame, fx: int, fy: int) -> DataFrame:
    """Admin layer (cell, gcol, grow, code, border) on a coarser grid: the first most frequent code, the largest border count."""
    return block_mode(admin, fx, fy, "code", "first").join(block_agg(admin, fx, fy, "max", ["border"]), ["bcol", "brow"])


def conform_to_grid(df: DataFrame, grid: DataFrame, key: str = "cell", defaults: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(every grid cell with df's columns or their defaults, the cells of df that the grid doesn't have)."""
    out = grid.select(key).join(df, key, "left")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(c, F.lit(v)))
    return out, df.join(grid.select(key), key, "left_anti")


def uncovered_zones(cells: DataFrame, zone: str, value: str) -> DataFrame:
    """Zones all of whose cells are null in a layer."""
    return cells.groupBy(zone).agg(F.count(value).alias("n")).filter("n = 0").select(zone)


def index_codes(codes: DataFrame, split: DataFrame) -> DataFrame:
    """0-based index of codes: by alphabet, those with X first after them, `No land` next, then countries with regions.

    ``codes``: code (a dimension table of some hundred rows); ``split``: code of countries that have regions.
    """
    with_regions = split.select("code").distinct().withColumn("__split", F.lit(1))
    bucket = F.when(F.col("code") == "No land", 2).when(F.col("__split") == 1, 3).when(F.col("code").startswith("X"), 1).otherwise(0)
    ranked = codes.select("code").distinct().join(with_regions, "code", "left").withColumn("bucket", bucket)
    return ranked.select("code", (F.row_number().over(Window.orderBy("bucket", "code")) - 1).alias("idx"))
