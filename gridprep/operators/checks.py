"""Compatibility and conservation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridprep.functions.geo import GridSpec


def check_compat(source: GridSpec, target: GridSpec) -> dict[str, bool]:
    """Whether extents are equal within 1% of a cell, resolutions whole multiples, origins aligned, and the target covered."""
    rx, ry = target.res_lon / source.res_lon, target.res_lat / source.res_lat
    near = lambda a, b, cell: abs(a - b) <= 0.01 * cell
    whole = lambda x, tol: abs(x - round(x)) <= tol
    return {
        "same_extent": near(source.xmin, target.xmin, source.res_lon) and near(source.xmax, target.xmax, source.res_lon) and near(source.ymax, target.ymax, source.res_lat) and near(source.ymin, target.ymin, source.res_lat),
        "multiple": whole(rx, 1e-4) and whole(ry, 1e-4) and rx >= 1 - 1e-4 and ry >= 1 - 1e-4,
        "aligned": whole((target.xmin - source.xmin) / source.res_lon, 1e-3) and whole((source.ymax - target.ymax) / source.res_lat, 1e-3),
        "covers": source.xmin <= target.xmin + 1e-9 and source.xmax >= target.xmax - 1e-9 and source.ymin <= target.ymin + 1e-9 and source.ymax >= target.ymax - 1e-9,
    }


def compat_columns(source: str, target: str) -> dict[str, Column]:
    """The predicates of check_compat for struct columns of lattices (xmin, ymax, res_lon, res_lat, ncol, nrow)."""
    part = lambda c: {k: F.col(f"{c}.{k}") for k in ("xmin", "ymax", "res_lon", "res_lat", "ncol", "nrow")}
    a, b = part(source), part(target)
    for x in (a, b):
        x["xmax"], x["ymin"] = x["xmin"] + x["ncol"] * x["res_lon"], x["ymax"] - x["nrow"] * x["res_lat"]
    rx, ry = b["res_lon"] / a["res_lon"], b["res_lat"] / a["res_lat"]
    near = lambda k, cell: F.abs(a[k] - b[k]) <= 0.01 * a[cell]
    whole = lambda x, tol: F.abs(x - F.round(x)) <= tol
    return {
        "same_extent": near("xmin", "res_lon") & near("xmax", "res_lon") & near("ymax", "res_lat") & near("ymin", "res_lat"),
        "multiple": whole(rx, 1e-4) & whole(ry, 1e-4) & (rx >= 1 - 1e-4) & (ry >= 1 - 1e-4),
        "aligned": whole((b["xmin"] - a["xmin"]) / a["res_lon"], 1e-3) & whole((a["ymax"] - b["ymax"]) / a["res_lat"], 1e-3),
        "covers": (a["xmin"] <= b["xmin"] + 1e-9) & (a["xmax"] >= b["xmax"] - 1e-9) & (a["ymin"] <= b["ymin"] + 1e-9) & (a["ymax"] >= b["ymax"] - 1e-9),
    }


def spec_row(df: DataFrame, res_lon: float, res_lat: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """spec_of as a table of one row with a struct ``spec``."""
    cells = lambda c, res: (F.round((F.max(c) - F.min(c)) / res) + 1).cast("int")
    spec = F.struct(
        (F.min(lon) - res_lon / 2).alias("xmin"), (F.max(lat) + res_lat / 2).alias("ymax"), F.lit(float(res_lon)).alias("res_lon"), F.lit(float(res_lat)).alias("res_lat"),
        cells(lon, res_lon).alias("ncol"), cells(lat, res_lat).alias("nrow"),
    )
    return df.agg(spec.alias("spec"))


def sum_kept(before: Column, after: Column, tolerance: float = 1e-6) -> Column:
    """Whether two sums agree within the relative tolerance; missing ones are 0."""
    x, y = F.coalesce(before, F.lit(0.0)), F.coalesce(after, F.lit(0.0))
    return F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y), F.lit(1e-300))


def loss_within(before: Column, lost: Column, tolerance: float = 1e-6) -> Column:
    """Whether what was lost of a sum is within the relative tolerance, by no difference of sums, which would round it."""
    return F.abs(lost) <= F.lit(tolerance) * F.abs(before)


def spec_of(df: DataFrame, res_lon: float, res_lat: float, lon: str = "lon", lat: str = "lat") -> GridSpec:
    """The lattice around all cell centres of a table: one aggregate."""
    x = df.agg(F.min(lon), F.max(lon), F.min(lat), F.max(lat)).first()
    return GridSpec(x[0] - res_lon / 2, x[3] + res_lat / 2, res_lon, res_lat, round((x[1] - x[0]) / res_lon) + 1, round((x[3] - x[2]) / res_lat) + 1)


def assert_sum(a: DataFrame, b: DataFrame, value_a: str, value_b: str, tolerance: float = 1e-6) -> None:
    """An error if two tables' sums differ by more than the relative tolerance."""
    x = a.agg(F.sum(value_a)).first()[0] or 0.0
    y = b.agg(F.sum(value_b)).first()[0] or 0.0
    if abs(x - y) > tolerance * max(abs(x), abs(y), 1e-300):
        raise ValueError(f"sums differ: {x} and {y}")
