"""Row-wise work on cells: areas, fractions, thresholds, caps, rules, suitability, extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.functions.geo import GridSpec, cell_area


def fill_area_by_row(df: DataFrame, row: str = "grow", lat: str = "lat", area: str = "area", dlon: float = 0.5, dlat: float = 0.5) -> DataFrame:
    """Missing areas from the same row, else from the mirrored latitude, else computed."""
    known = df.groupBy(row).agg(F.max(area).alias("__row"))
    mirrored = df.groupBy((-F.col(lat)).alias("__lat")).agg(F.max(area).alias("__mirror"))
    # one row for each row of the lattice on either side
    out = df.join(known, row, "left").join(mirrored, F.round(F.col(lat), 6) == F.round(F.col("__lat"), 6), "left")
    return out.withColumn(area, F.coalesce(area, "__row", "__mirror", cell_area(lat, dlon, dlat))).drop("__row", "__lat", "__mirror")


def to_area(fraction: Column | str, area: Column | str) -> Column:
    return (F.col(fraction) if isinstance(fraction, str) else fraction) * (F.col(area) if isinstance(area, str) else area)


def to_fraction(value: Column | str, area: Column | str) -> Column:
    """Null for cells without area."""
    a = F.col(area) if isinstance(area, str) else area
    return (F.col(value) if isinstance(value, str) else value) / F.when(a != 0, a)


def clamp_to_area(df: DataFrame, value: str, area: str, tolerance: float = 1e-4) -> DataFrame:
    """value cut to the cell's area; ``over`` says whether it was above by more than the relative tolerance."""
    over = F.coalesce(F.col(value) > F.col(area) * (1 + tolerance), F.lit(False))
    return df.withColumn("over", over).withColumn(value, F.when(F.col(value) > F.col(area), F.col(area)).otherwise(F.col(value)))


def pick_scalar(df: DataFrame, cols: Sequence[str], bits: int = 15, powers: int = 4) -> DataFrame:
    """One row: the power of ten that makes all coordinates whole below 2^bits, or else the largest that fits."""
    most = F.greatest(*(F.max(F.abs(c)) for c in cols)) if len(cols) > 1 else F.max(F.abs(cols[0]))
    whole = [F.min(F.least(*(F.abs(F.col(c) * 10**k - F.round(F.col(c) * 10**k)) < 1e-6 for c in cols)) if len(cols) > 1 else F.abs(F.col(cols[0]) * 10**k - F.round(F.col(cols[0]) * 10**k)) < 1e-6).alias(f"w{k}") for k in range(powers + 1)]
    one = df.agg(most.alias("most"), *whole)
    fits = [F.col("most") * 10**k < 2**bits for k in range(powers + 1)]
    scalar = F.lit(None).cast("int")
    for k in range(powers, -1, -1):
        scalar = F.when(fits[k] & F.col(f"w{k}"), F.lit(10**k)).otherwise(scalar)
    for_size = F.lit(1)
    for k in range(powers + 1):
        for_size = F.when(fits[k], F.lit(10**k)).otherwise(for_size)
    return one.select(F.coalesce(scalar, for_size).cast("int").alias("scale"), scalar.isNotNull().alias("exact"))


def rounding_loss(df: DataFrame, fraction: str, area: str) -> DataFrame:
    """Area-weighted sums before and after rounding fractions to whole percent."""
    before, after = F.sum(F.col(fraction) * F.col(area)), F.sum(F.round(F.col(fraction) * 100) / 100 * F.col(area))
    return df.agg(before.alias("before"), after.alias("after")).withColumn("loss", F.col("before") - F.col("after"))


def drop_below(value: str, least: float) -> Column:
    """Values under the threshold become 0."""
    return F.when(F.col(value) < least, F.lit(0.0)).otherwise(F.col(value))


def mask_where(df: DataFrame, value: str, layer: str) -> DataFrame:
    """value only where the layer isn't 0; zeros become null."""
    return df.withColumn(value, F.when((F.col(layer) != 0) & (F.col(value) != 0), F.col(value)))


def cap_with_remainder(df: DataFrame, rate: str, cap: float, area: str) -> DataFrame:
    """The rate cut to a cap, and what was cut as an absolute amount in ``excess``."""
    return df.withColumn("excess", F.greatest(F.col(rate) - cap, F.lit(0.0)) * F.col(area)).withColumn(rate, F.when(F.col(rate) > cap, F.lit(float(cap))).otherwise(F.col(rate)))


def apply_rules(df: DataFrame, rules: DataFrame, key: str, built: str | None = None, last_year: int | None = None, needed: str | None = None) -> DataFrame:
    """Rows whose status has no rule or the action keep; rows without ``needed`` or built after ``last_year`` go.

    ``rules``: key and action, a table of statuses; an action that isn't drop keeps its rows.
    """
    dropped = rules.filter(F.col("action") == "drop").select(key).distinct()
    out = df.join(dropped, key, "left_anti")
    if needed:
        out = out.filter(F.col(needed).isNotNull())
    return out.filter(F.col(built).isNull() | (F.col(built) <= last_year)) if built else out


def impute_area(capacity: str, height: str | None = None) -> Column:
    """Surface area of a reservoir from its capacity, and its height where known."""
    plain = F.pow(F.col(capacity) / 30.684, F.lit(1 / 0.9578))
    if height is None:
        return plain
    return F.when(F.col(height) > 0, F.pow(F.col(capacity) / 0.678, F.lit(1 / 0.9229)) / F.col(height)).otherwise(plain)


def code_purpose(use: str) -> Column:
    """hydropower 2, irrigation 1, anything else 3."""
    u = F.lower(F.col(use))
    return F.when(u.startswith("hydro"), 2).when(u == "irrigation", 1).otherwise(3)


def prep_soil_attributes(df: DataFrame, default_code: int, default_texture: int) -> DataFrame:
    """The 1974 symbol where the 1990 one is missing, a default texture for one code, shares from percent."""
    texture = F.when(F.col("texture").isNull() & (F.col("soil_id") == default_code), F.lit(default_texture)).otherwise(F.col("texture"))
    return df.withColumn("sym", F.coalesce("sym90", "sym74")).withColumn("texture", texture).withColumn("share", F.col("share") / 100)


def cropping_suitability(df: DataFrame, thresholds: DataFrame, irrigated: bool = False) -> DataFrame:
    """cell and suitability 0 to 3: how many of single, double and triple cropping have all their thresholds met.

    ``df``: cell, zone, variable, value; ``thresholds``: level, variable, zone (null: all others), least. The moisture
    variable doesn't count for irrigated crops; a missing value makes the cell's result null.
    """
    t = F.broadcast(thresholds.filter(F.col("variable") != "moisture") if irrigated else thresholds)
    own = df.filter(F.col("variable") != "moisture") if irrigated else df
    zoned = t.filter("zone is not null")
    exact = own.join(zoned, ["variable", "zone"]).select("cell", "variable", "level", "value", "least")
    rest = own.join(zoned.select("variable", "zone").distinct(), ["variable", "zone"], "left_anti")
    rest = rest.join(t.filter("zone is null").drop("zone"), "variable").select("cell", "variable", "level", "value", "least")
    met = exact.unionByName(rest).groupBy("cell", "level").agg(F.min((F.col("value") >= F.col("least")).cast("int")).alias("met"), F.max(F.col("value").isNull()).alias("missing"))
    return met.groupBy("cell").agg(F.when(~F.max("missing"), F.sum("met")).cast("int").alias("suitability"))


def floor_suitability(x: str) -> Column:
    return F.greatest(F.coalesce(F.col(x), F.lit(1)), F.lit(1))


def normalise_rows(df: DataFrame, row: str, lat: str, nrow: int) -> DataFrame:
    """Rows counted from the north: flipped if latitudes grow with the row."""
    up = df.agg(F.corr(row, lat).alias("c")).select((F.coalesce("c", F.lit(-1.0)) > 0).alias("__up"))
    # a single row, known before the join
    return df.crossJoin(F.broadcast(up)).withColumn(row, F.when(F.col("__up"), F.lit(nrow - 1) - F.col(row)).otherwise(F.col(row))).drop("__up")


def conform_extent(df: DataFrame, spec: GridSpec, target: GridSpec, fill: float | None = None, dense: bool = False) -> DataFrame:
    """``gcol``, ``grow`` and value on another extent of the same resolution; with ``dense`` also its new cells, filled."""
    dx, dy = round((target.xmin - spec.xmin) / spec.res_lon), round((spec.ymax - target.ymax) / spec.res_lat)
    moved = df.withColumn("gcol", F.col("gcol") - dx).withColumn("grow", F.col("grow") - dy)
    inside = moved.filter(F.col("gcol").between(0, target.ncol - 1) & F.col("grow").between(0, target.nrow - 1))
    if not dense:
        return inside
    lattice = df.sparkSession.range(target.ncol * target.nrow).select((F.col("id") % target.ncol).cast("int").alias("gcol"), F.floor(F.col("id") / target.ncol).cast("int").alias("grow"))
    out = lattice.join(inside.withColumn("__had", F.lit(True)), ["gcol", "grow"], "left")
    return out.withColumn("value", F.when(F.col("__had").isNull(), F.lit(fill).cast("double")).otherwise(F.col("value"))).drop("__had")
