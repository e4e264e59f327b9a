"""Area of the union of polygons in grid cells: what several pieces of one code cover counts once.

A column of the lattice is swept from north to south. How many pieces lie over each other below an edge is one more or less
than above it, so in a strip of longitudes that no two edges cross in, the counts along its edges tell what is covered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridprep.functions.geo import EARTH_RADIUS, GridSpec
from gridprep.operators.overlay import NOTHING, ring_sign
from gridprep.session import arrow_rows

#: Strips narrower than this (degrees) are rounding, and pairs of edges that are looked at at once.
NARROW, PAIRS = 1e-11, 2_000_000


def crossings(xl: np.ndarray, yl: np.ndarray, xr: np.ndarray, yr: np.ndarray) -> np.ndarray:
    """The longitudes at which two of the edges (west to east) cross inside both."""
    found = []
    slope = (yr - yl) / (xr - xl)
    step = max(1, PAIRS // max(1, len(xl)))
    for a in range(0, len(xl), step):
        own = slice(a, a + step)
        with np.errstate(divide="ignore", invalid="ignore"):
            x = (yl[None, :] - yl[own, None] + slope[own, None] * xl[own, None] - slope[None, :] * xl[None, :]) / (slope[own, None] - slope[None, :])
        low, high = np.maximum(xl[own, None], xl[None, :]), np.minimum(xr[own, None], xr[None, :])
        found.append(x[(x > low) & (x < high)])
    return np.concatenate(found) if found else np.zeros(0)


def mean_sine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The mean of the sine along a straight line from a to b (degrees)."""
    half = np.radians(b - a) / 2
    return np.sin(np.radians(a + b) / 2) * np.where(half == 0, 1.0, np.sin(half) / np.where(half == 0, 1.0, half))


class Profile:
    """How many pieces cover each longitude along a line: ``x`` ascending, ``n[i]`` between x[i] and x[i + 1], 0 outside."""

    def __init__(self) -> None:
        self.x, self.n = np.zeros(0), np.zeros(0, np.int64)

    def at(self, x: np.ndarray) -> np.ndarray:
        if len(self.x) < 2:
            return np.zeros(len(x), np.int64)
        k = np.searchsorted(self.x, x, side="right") - 1
        inside = (k >= 0) & (k < len(self.n))
        return np.where(inside, self.n[np.clip(k, 0, len(self.n) - 1)], 0)

    def width(self) -> float:
        return float(np.diff(self.x)[self.n > 0].sum()) if len(self.x) > 1 else 0.0


def swept(top: Profile, edges: np.ndarray, delta: np.ndarray, north: float, south: float) -> tuple[float, Profile]:
    """Of a cell with ``edges`` (rows of xl, yl, xr, yr): the covered width times the mean difference of sines (in degrees of
    longitude), and the profile along its southern side."""
    xl, yl, xr, yr = edges.T
    x = np.unique(np.concatenate((xl, xr, top.x, crossings(xl, yl, xr, yr))))
    x = x[np.concatenate(([True], np.diff(x) > NARROW))]
    if len(x) < 2:
        return 0.0, top
    a, b = x[:-1], x[1:]
    middle = (a + b) / 2
    first, last = np.searchsorted(middle, xl), np.searchsorted(middle, xr)
    n = np.maximum(last - first, 0)
    edge = np.repeat(np.arange(len(xl)), n)
    strip = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    slope = (yr - yl) / (xr - xl)
    lat = lambda at: yl[edge] + slope[edge] * (at[strip] - xl[edge])
    order = np.lexsort((-lat(middle), strip))
    edge, strip = edge[order], strip[order]
    start = top.at(middle)
    run = np.cumsum(delta[edge])
    begins = np.searchsorted(strip, np.arange(len(a)))
    ends = np.searchsorted(strip, np.arange(len(a)), side="right")
    base = np.concatenate(([0], run))[begins]
    after = start[strip] + run - base[strip]
    before = after - delta[edge]
    total = np.zeros(len(a))
    height = mean_sine(lat(a), lat(b))
    np.add.at(total, strip, height * ((after > 0).astype(np.int64) - (before > 0).astype(np.int64)))
    final = start + np.where(ends > begins, np.concatenate(([0], run))[ends] - base, 0)
    total += np.sin(np.radians(north)) * (start > 0) - np.sin(np.radians(south)) * (final > 0)
    below = Profile()
    below.x, below.n = x, final
    return float((total * (b - a)).sum()), below


def polygon_cell_union(polygons: DataFrame, spec: GridSpec) -> DataFrame:
    """code, gcol, grow, area: the area of each cell that the polygons of a code cover, however often.

    ``polygons``: poly_id, part, ring (0: outer, others: holes), code, points ARRAY<STRUCT<lon,lat>>; rings don't cross
    themselves. What is a hole of one polygon and covered by another counts. For polygons that don't overlap these are the
    areas of polygon_cell_area. Edges go to the columns and rows they cross; a code's edges in a column of the lattice are
    swept in one task.
    """
    arrow_rows(polygons.sparkSession)
    west, north, dx, dy = (F.lit(float(v)) for v in (spec.xmin, spec.ymax, spec.res_lon, spec.res_lat))
    rings = polygons.filter(F.size("points") >= 3).withColumn("sign", ring_sign() * F.when(F.col("ring") == 0, 1.0).otherwise(-1.0)).filter("sign <> 0")
    following = F.concat(F.slice("points", 2, F.size("points")), F.slice("points", 1, 1))
    # from west to east: the inside lies below an edge that went this way along its ring, and above any other
    edge = F.zip_with("points", following, lambda p, q: F.when(p["lon"] < q["lon"], F.struct(p["lon"].cast("double").alias("xl"), p["lat"].cast("double").alias("yl"), q["lon"].cast("double").alias("xr"), q["lat"].cast("double").alias("yr"), F.lit(1.0).alias("way"))).otherwise(
        F.struct(q["lon"].cast("double").alias("xl"), q["lat"].cast("double").alias("yl"), p["lon"].cast("double").alias("xr"), p["lat"].cast("double").alias("yr"), F.lit(-1.0).alias("way"))))
    edges = rings.select("code", "sign", F.explode(edge).alias("e")).select("code", "e.*", (F.col("sign") * F.col("e.way")).cast("int").alias("delta")).filter("xl < xr")
    within = lambda x, low, high: F.least(F.greatest(x, low), high)
    c0 = F.greatest(F.floor((F.col("xl") - west) / dx), F.lit(0)).cast("int")
    c1 = F.least(F.ceil((F.col("xr") - west) / dx) - 1, F.lit(spec.ncol - 1)).cast("int")
    parts = edges.withColumn("c0", c0).withColumn("c1", c1).filter("c0 <= c1").withColumn("gcol", F.explode(F.sequence("c0", "c1")))
    parts = parts.withColumn("slope", (F.col("yr") - F.col("yl")) / (F.col("xr") - F.col("xl")))
    left, right = west + F.col("gcol") * dx, west + (F.col("gcol") + 1) * dx
    parts = parts.withColumn("xa", within(F.col("xl"), left, right)).withColumn("xb", within(F.col("xr"), left, right)).filter("xa < xb")
    lat = lambda x: F.col("yl") + F.col("slope") * (x - F.col("xl"))
    parts = parts.withColumn("ya", lat(F.col("xa"))).withColumn("yb", lat(F.col("xb")))
    row = lambda y: F.greatest(F.floor((north - y) / dy), F.lit(-1)).cast("int")
    parts = parts.withColumn("r0", row(F.greatest("ya", "yb"))).withColumn("r1", F.least(row(F.least("ya", "yb")), F.lit(spec.nrow - 1))).filter("r0 <= r1")
    parts = parts.withColumn("grow", F.explode(F.sequence("r0", "r1")))
    south = north - (F.col("grow") + 1) * dy
    upper = F.when(F.col("grow") < 0, F.lit(1e9)).otherwise(north - F.col("grow") * dy)
    # where the line meets the row's sides
    level = F.col("slope") == 0
    at = lambda y: F.col("xl") + (y - F.col("yl")) / F.col("slope")
    low, high = F.least(at(south), at(upper)), F.greatest(at(south), at(upper))
    parts = parts.withColumn("xs", F.when(level, F.col("xa")).otherwise(within(F.col("xa"), low, high))).withColumn("xt", F.when(level, F.col("xb")).otherwise(within(F.col("xb"), low, high)))
    parts = parts.filter("xs < xt").select("code", "gcol", "grow", "xs", lat(F.col("xs")).alias("ys"), "xt", lat(F.col("xt")).alias("yt"), "delta")
    code_kind = polygons.schema["code"].dataType.simpleString()

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("grow", kind="stable")
        rows = pdf["grow"].to_numpy(np.int64)
        every, delta = pdf[["xs", "ys", "xt", "yt"]].to_numpy(np.float64), pdf["delta"].to_numpy(np.int64)
        cut = np.flatnonzero(np.diff(rows, prepend=-2))
        profile, out_row, out_area = Profile(), [], []
        for k, (a, b) in enumerate(zip(cut, [*cut[1:], len(rows)], strict=True)):
            r = int(rows[a])
            top = spec.ymax - r * spec.res_lat if r >= 0 else 90.0
            area, profile = swept(profile, every[a:b], delta[a:b], top, spec.ymax - (r + 1) * spec.res_lat)
            if r >= 0:
                out_row.append(np.array([r]))
                out_area.append(np.array([area]))
            after = np.arange(r + 1, int(rows[cut[k + 1]]) if k + 1 < len(cut) else spec.nrow)
            if len(after) and (width := profile.width()) > 1e-12:
                out_row.append(after)
                out_area.append(width * (np.sin(np.radians(spec.ymax - after * spec.res_lat)) - np.sin(np.radians(spec.ymax - (after + 1) * spec.res_lat))))
        grow = np.concatenate(out_row) if out_row else np.zeros(0, np.int64)
        area = np.radians(np.concatenate(out_area)) * EARTH_RADIUS**2 if out_area else np.zeros(0)
        return pd.DataFrame({"code": [pdf["code"].iloc[0]] * len(grow), "gcol": int(pdf["gcol"].iloc[0]), "grow": grow, "area": area})

    return parts.groupBy("code", "gcol").applyInPandas(sweep, f"code {code_kind}, gcol int, grow int, area double").filter(F.col("area") > NOTHING)
