"""Fertiliser and manure: weighted means, as-of years, hierarchical medians, group fallback, trends, rebasing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridprep.operators.medians import exact_medians
from gridprep.session import stored

Keys = Sequence[str]


def weighted_mean(rates: DataFrame, by: Keys, rate: str = "rate", weight: str = "weight") -> DataFrame:
    """sum(rate * weight) / sum(weight) where there is a rate; 0 without any weight."""
    w = F.sum(F.when(F.col(rate).isNotNull(), F.col(weight)))
    return rates.groupBy(*by).agg(F.coalesce(F.sum(F.col(rate) * F.col(weight)) / F.when(w > 0, w), F.lit(0.0)).alias(rate))


def asof_year(left: DataFrame, right: DataFrame, keys: Keys, mode: str = "replicate", year: str = "year") -> DataFrame:
    """left with right's columns of the nearest year (the earlier of two as near); mode zero: 0 where the year itself is missing.

    Years meet years only: a map from wanted to given years, each table's distinct years at most, is joined back.
    """
    values = [c for c in right.columns if c not in (*keys, year)]
    if mode == "zero":
        return left.join(right, [*keys, year], "left").fillna(0.0, values)
    wanted = left.select(F.col(year).alias("__want")).distinct()
    given = right.agg(F.sort_array(F.collect_set(year)).alias("__given"))
    distance = lambda y: F.struct(F.abs(y - F.col("__want")).alias("d"), y.alias("y"))
    years = wanted.crossJoin(F.broadcast(given)).select(F.col("__want").alias(year), F.array_min(F.transform("__given", distance))["y"].alias("src_year"))
    return left.join(years, year, "left").join(right.withColumnRenamed(year, "src_year"), [*keys, "src_year"], "left")


def rate_fill(cells: DataFrame, levels: Keys, value: str = "rate", least: int = 10, share: float = 0.25, national: str | None = None) -> DataFrame:
    """Missing rates from the median of the same district, state or country (``levels``, finest first), with fill_level
    1 for own values and 2, 3, 4 for the levels, null where none is.

    Border cells (``border`` > 1) don't count unless all of the unit are; a unit needs ``least`` source cells or ``share``
    of its own. ``national`` names a flag column: units of flagged sources are only looked for in the country.
    """
    out = cells
    # a unit has border cells only, or they don't count: so a row for each unit and kind of cell, and all levels at once
    inner = (F.col("border") <= 1).alias("inner")
    usable = lambda k: F.col(value).isNotNull() & ~F.col(national) if national and k + 1 < len(levels) else F.col(value).isNotNull()
    units = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(level).cast("string").alias("unit"), F.when(usable(k), F.col(value)).alias("v")) for k, level in enumerate(levels))))
    rows = cells.select(F.coalesce(inner, F.lit(False)).alias("inner"), units.alias("u")).select("inner", "u.k", "u.unit", "u.v")
    medians = exact_medians(rows, ["k", "unit", "inner"], "v")
    sizes = rows.groupBy("k", "unit").agg(F.count(F.lit(1)).alias("size"), F.bool_or("inner").alias("inner"))
    found = sizes.join(medians, [sizes["k"] == medians["k"], sizes["unit"].eqNullSafe(medians["unit"]), sizes["inner"] == medians["inner"]])
    enough = (F.col("n") >= least) | (F.col("n") >= F.col("size") * share)
    found = stored(found.filter(enough).select(sizes["k"], sizes["unit"], "median"))
    for k, level in enumerate(levels):
        unit = found.filter(F.col("k") == k).select(F.col("unit").alias("__unit"), F.col("median").alias(f"__{k}"))
        out = out.join(unit, F.col(level).cast("string") == F.col("__unit"), "left").drop("__unit")
    fill = F.when(F.col(value).isNotNull(), 1)
    for k in range(len(levels)):
        fill = fill.when(F.col(f"__{k}").isNotNull(), k + 2)
    return out.withColumn("fill_level", fill).withColumn(value, F.coalesce(value, *(F.col(f"__{k}") for k in range(len(levels))))).drop(*(f"__{k}" for k in range(len(levels))))


def unit_median(cells: DataFrame, unit: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """One value for each unit: constant, or the lowest mode if it equals the median, else the median; ``spread`` marks the last."""
    counted = cells.filter(F.col(value).isNotNull()).groupBy(unit, value).agg(F.count(F.lit(1)).alias("n"))
    mode = counted.groupBy(unit).agg(F.min_by(value, F.struct((-F.col("n")).alias("a"), value)).alias("mode"), F.count(F.lit(1)).alias("k"))
    both = mode.join(exact_medians(cells, [unit], value), unit)
    return both.select(unit, F.col("median").alias(value), ((F.col("k") > 1) & (F.abs(F.col("mode") - F.col("median")) > tolerance)).alias("spread"))


def group_fallback(values: DataFrame, membership: DataFrame, least: int = 3) -> DataFrame:
    """Countries without a value get the median of a group's donors: the smallest region, then the next larger, then the
    world, with the same development status first, then a related one, then any.

    ``values``: country, value (null where missing); ``membership``: country, level (1 region, 2 continent, 3 world), grp,
    status, broad (a coarser status). A step needs ``least`` donors, but the very last takes any number. fill_level: 0 own,
    4 + level plus 0.25 for the coarser status and 0.5 for any; n_sources: the donors. Both belong to the filled country.
    """
    donors = values.filter("value is not null").join(membership, "country")
    needy = values.filter("value is null").select("country").join(membership, "country")
    found = None
    last = membership.agg(F.max("level").alias("last"))
    for step, match in ((0.0, ["status"]), (0.25, ["broad"]), (0.5, [])):
        pool = donors.groupBy("level", "grp", *match).agg(F.median("value").alias("value"), F.count(F.lit(1)).alias("n_sources"))
        hit = needy.join(pool, ["level", "grp", *match]).select("country", (F.col("level") + 4 + step).cast("double").alias("fill_level"), "value", "n_sources")
        found = hit if found is None else found.unionByName(hit)
    enough = found.crossJoin(F.broadcast(last)).filter((F.col("n_sources") >= least) | (F.col("fill_level") == F.col("last") + 4.5))
    best = enough.groupBy("country").agg(F.min(F.struct("fill_level", "value", "n_sources")).alias("b")).select("country", F.col("b.value").alias("__v"), F.col("b.fill_level").alias("__l"), F.col("b.n_sources").alias("__n"))
    out = values.join(best, "country", "left")
    own = F.col("value").isNotNull()
    return out.select("country", F.coalesce("value", "__v").alias("value"), F.when(own, F.lit(0.0)).otherwise(F.col("__l")).alias("fill_level"), F.when(own, F.lit(1)).otherwise(F.col("__n")).cast("long").alias("n_sources"))


def trend_fill(cells: DataFrame, levels: Keys, reference: int, least: int = 3) -> DataFrame:
    """country, year, ratio, fill_level from cell rates of all years: gaps filled by rate_fill, divided by the reference
    year, gaps of the ratios filled again; the country's value is its cells' median. Years without any data: 0, code -1.

    ``cells``: cell, year, rate, border, and ``levels`` (finest first, the last one being the country).
    """
    keyed = cells.withColumns({f"__u{k}": F.concat_ws("/", F.col(c).cast("string"), F.col("year").cast("string")) for k, c in enumerate(levels)})
    units = [f"__u{k}" for k in range(len(levels))]
    first = rate_fill(keyed, units, "rate", least)
    at = F.max(F.when(F.col("year") == reference, F.col("rate"))).over(Window.partitionBy("cell"))
    ratio = first.withColumn("ratio", F.col("rate") / F.when(at != 0, at)).withColumn("__first", F.col("fill_level")).drop("fill_level")
    second = rate_fill(ratio, units, "ratio", least)
    level = F.max(F.greatest(F.coalesce("__first", F.lit(0)), F.coalesce("fill_level", F.lit(0))))
    second = stored(second.select(F.col(levels[-1]).alias("country"), "year", "ratio", "__first", "fill_level"))
    median = exact_medians(second, ["country", "year"], "ratio").select("country", "year", F.col("median").alias("ratio"))
    out = second.groupBy("country", "year").agg(level.alias("fill_level")).join(median, ["country", "year"], "left").select("country", "year", "ratio", "fill_level")
    return out.withColumn("fill_level", F.when(F.col("ratio").isNull(), -1).otherwise(F.col("fill_level"))).fillna(0.0, ["ratio"])


def apply_trend(pattern: DataFrame, trend: DataFrame) -> DataFrame:
    """cell, year, rate: the reference pattern times its country's ratio of each year."""
    return pattern.join(trend, "country").select("cell", "year", (F.col("rate") * F.col("ratio")).alias("rate"))


def rebase_rate(cells: DataFrame) -> DataFrame:
    """Rates per grid area to rates per crop land; ``lost``: the amount in cells without crop land. cells: rate, area, cropland."""
    amount = F.col("rate") * F.col("area")
    return cells.withColumn("lost", F.when(F.col("cropland") > 0, F.lit(0.0)).otherwise(F.coalesce(amount, F.lit(0.0)))).withColumn("rate", amount / F.when(F.col("cropland") > 0, F.col("cropland")))


def combine(fertiliser: DataFrame, manure: DataFrame, keys: Keys, availability: float = 0.6) -> DataFrame:
    """Fertiliser plus the available share of manure; null only where both are."""
    both = fertiliser.select(*keys, F.col("rate").alias("__f")).join(manure.select(*keys, F.col("rate").alias("__m")), [*keys], "full_outer")
    total = F.coalesce("__f", F.lit(0.0)) + F.coalesce("__m", F.lit(0.0)) * availability
    return both.select(*keys, F.when(F.col("__f").isNotNull() | F.col("__m").isNotNull(), total).alias("rate"))
