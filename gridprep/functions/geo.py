"""Column expressions on positions, areas and cells of a regular longitude/latitude grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: radius of the earth in m.
EARTH_RADIUS = 6371000.785


@dataclass(frozen=True)
class GridSpec:
    """A lattice: west and north edges, cell sizes in degrees, numbers of columns and rows; row 0 is the northernmost."""

    xmin: float
    ymax: float
    res_lon: float
    res_lat: float
    ncol: int
    nrow: int

    @property
    def xmax(self) -> float:
        return self.xmin + self.ncol * self.res_lon

    @property
    def ymin(self) -> float:
        return self.ymax - self.nrow * self.res_lat

    @property
    def wraps(self) -> bool:
        return abs(self.ncol * self.res_lon - 360) < 1e-9


def _col(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def cell_area(lat: Column | str, dlon: Column | str | float, dlat: Column | str | float) -> Column:
    """Area in m2 of a cell around latitude ``lat`` on a sphere."""
    side = EARTH_RADIUS * 3.141592653589793 / 180
    return F.lit(side) * _col(dlon) * F.lit(side) * _col(dlat) * F.cos(F.radians(_col(lat)))


def haversine(lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str) -> Column:
    """Distance in m on the sphere."""
    a, b, c, d = (F.radians(_col(x)) for x in (lon1, lat1, lon2, lat2))
    h = F.pow(F.sin((d - b) / 2), 2) + F.cos(b) * F.cos(d) * F.pow(F.sin((c - a) / 2), 2)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def grid_col(lon: Column | str, spec: GridSpec) -> Column:
    """Column of a longitude, which wraps at 360 degrees; null outside."""
    c = F.floor(F.pmod(_col(lon) - spec.xmin, F.lit(360.0)) / spec.res_lon).cast("int")
    return F.when((c >= 0) & (c < spec.ncol), c)


def grid_row(lat: Column | str, spec: GridSpec) -> Column:
    """Row of a latitude, counted from the north whatever the order in the file; null outside."""
    r = F.floor((F.lit(spec.ymax) - _col(lat)) / spec.res_lat).cast("int")
    return F.when((r >= 0) & (r < spec.nrow), r)


def to_cell(lon: Column | str, lat: Column | str, spec: GridSpec) -> Column:
    return (grid_row(lat, spec).cast("long") * spec.ncol + grid_col(lon, spec)).cast("long")


def to_lon(cell: Column | str, spec: GridSpec) -> Column:
    """Longitude of the cell's centre, from -180 up."""
    x = F.lit(spec.xmin) + (F.pmod(_col(cell), F.lit(spec.ncol)) + 0.5) * spec.res_lon
    return F.when(x >= 180, x - 360).otherwise(x)


def to_lat(cell: Column | str, spec: GridSpec) -> Column:
    return F.lit(spec.ymax) - (F.floor(_col(cell) / spec.ncol) + 0.5) * spec.res_lat


def resolution_label(spec: GridSpec) -> str:
    """`30arcmin`, or `5arcmin_by_10arcmin` where both sizes differ; arc seconds where minutes aren't whole."""

    def one(x: float) -> str:
        minutes = x * 60
        return f"{round(minutes)}arcmin" if abs(minutes - round(minutes)) < 1e-6 and round(minutes) else f"{round(x * 3600, 4):g}arcsec"

    lon, lat = one(spec.res_lon), one(spec.res_lat)
    return lon if lon == lat else f"{lon}_by_{lat}"


def resolution_labels(res_lon: Column | str, res_lat: Column | str) -> Column:
    """resolution_label of columns of cell sizes in degrees."""

    def one(x: Column) -> Column:
        minutes = x * 60
        whole = (F.abs(minutes - F.round(minutes)) < 1e-6) & (F.round(minutes) > 0)
        seconds = F.regexp_replace(F.round(x * 3600, 4).cast("string"), r"\.0$", "")
        return F.when(whole, F.concat(F.round(minutes).cast("long").cast("string"), F.lit("arcmin"))).otherwise(F.concat(seconds, F.lit("arcsec")))

    lon, lat = one(_col(res_lon)), one(_col(res_lat))
    return F.when(lon == lat, lon).otherwise(F.concat(lon, F.lit("_by_"), lat))


def logit(x: Column | str) -> Column:
    """Null outside the open interval from 0 to 1."""
    x = _col(x)
    return F.when((x > 0) & (x < 1), F.log(x / F.when(x < 1, 1 - x)))


def logistic(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-_col(x)))
