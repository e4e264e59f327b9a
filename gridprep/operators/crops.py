"""Crop statistics: zonal sums and quality, group consistency, class splits, artefact filter, intensity, group mixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def zonal_sum(cells: DataFrame, zones: DataFrame, value: str, by: Keys = (), on: Keys = ("cell",)) -> DataFrame:
    """Sums of a layer over zones (zone, cell), a cell in several zones counting in each; null where all values are."""
    return cells.join(zones, [*on]).groupBy("zone", *by).agg(F.sum(value).alias(value))


def zonal_quality(cells: DataFrame, zone: str = "zone") -> DataFrame:
    """Per zone, over cells with crop land: largest quality flag, share where the crop is, and share of border cells among
    those; for zones of one cell the border share is -1, and the presence share 0 or 1.

    ``cells``: zone, cropland, present, border, quality.
    """
    land = cells.filter("cropland > 0")
    n, present = F.count(F.lit(1)), F.count_if("present")
    border = F.when(n == 1, F.lit(-1.0)).otherwise(F.count_if(F.col("present") & F.col("border")) / F.when(present > 0, present))
    return land.groupBy(zone).agg(F.max("quality").alias("quality"), (present / n).alias("presence"), border.alias("border_share"), n.alias("cells"))


def rollup_items(items: DataFrame, members: DataFrame, by: Keys, value: str = "value", most: int = 10, relative: float = 0.01, absolute: float = 2.0) -> DataFrame:
    """Item groups rebuilt from their members, for groups in which at most ``most`` given totals differ from the members'
    sum by more than both tolerances. ``items``: by, item, value; ``members``: item, grp. Returns by, grp, value."""
    built = items.join(members, "item").groupBy(*by, "grp").agg(F.sum(value).alias("__built"))
    given = items.select(*by, F.col("item").alias("grp"), F.col(value).alias("__given"))
    both = built.join(given, [*by, "grp"], "left")
    off = F.abs(F.col("__given") - F.col("__built"))
    wrong = both.groupBy("grp").agg(F.count_if((off > F.abs("__built") * relative) & (off > absolute)).alias("wrong"))
    return both.join(wrong.filter(F.col("wrong") <= most), "grp", "left_semi").select(*by, "grp", F.col("__built").alias(value))


def map_sum(df: DataFrame, mapping: DataFrame, by: Keys, value: str) -> DataFrame:
    """Sums by functional type; a crop in two types counts in both (see double_mapped)."""
    return df.join(mapping, "crop").groupBy(*by, "type").agg(F.sum(value).alias(value))


def double_mapped(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("crop").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def parse_fractions(mapping: DataFrame, text: str = "classes") -> DataFrame:
    """(crop, class, share) from texts like `A 0.5 B 0.5`; a class without a number has all of it."""
    pairs = F.regexp_extract_all(F.col(text), F.lit(r"([A-Za-z_]+)(?: +([0-9.]+))?"), 1)
    shares = F.regexp_extract_all(F.col(text), F.lit(r"([A-Za-z_]+)(?: +([0-9.]+))?"), 2)
    x = mapping.select("crop", F.explode(F.arrays_zip(pairs.alias("class"), shares.alias("share"))).alias("x"))
    share = F.when(F.col("x.share") == "", F.lit(1.0)).otherwise(F.try_to_number(F.col("x.share"), F.lit("9.999999")).cast("double"))
    return x.select("crop", F.col("x.class").alias("class"), share.alias("share"))


def split_map(df: DataFrame, fractions: DataFrame, by: Keys, value: str) -> DataFrame:
    """Sums by class, each crop dealt out by its shares."""
    return df.join(fractions, "crop").groupBy(*by, "class").agg(F.sum(F.col(value) * F.col("share")).alias(value))


def unsplit(classes: DataFrame, base: DataFrame, fractions: DataFrame, by: Keys, value: str) -> DataFrame:
    """Class values dealt out over their crops in proportion to the crops' base values; (by, crop, value)."""
    own = base.join(fractions, "crop").withColumn("__own", F.col(value) * F.col("share")).drop(value)
    whole = F.sum("__own").over(Window.partitionBy(*by, "class"))
    own = own.withColumn("__share", F.col("__own") / F.when(whole != 0, whole))
    return own.join(classes, [*by, "class"]).groupBy(*by, "crop").agg(F.sum(F.col(value) * F.col("__share")).alias(value))


def min_unit_share(cells: DataFrame, levels: Keys, total: str, factor: float = 0.75) -> DataFrame:
    """For every level: the smallest number of crop-land cells of its units, over the country's, times ``factor``."""
    land = cells.filter("cropland > 0")
    n = land.groupBy(total).agg(F.count(F.lit(1)).alias("n"))
    out = n
    for level in levels:
        least = land.groupBy(total, level).agg(F.count(F.lit(1)).alias("m")).groupBy(total).agg(F.min("m").alias("m"))
        out = out.join(least, total).withColumn(f"share_{level}", F.col("m") / F.col("n") * factor).drop("m")
    return out.drop("n")


def use_pattern(quality: DataFrame, shares: DataFrame, zone: str, unit_shares: Keys) -> DataFrame:
    """Whether a crop's pattern may be used in a zone: few border cells, 1 ha or more, and presence in no less of it than
    its smallest unit of the level that the quality flag stands for (up to 0.25 country, 0.75 state, else district)."""
    q = quality.join(shares, zone)
    country, state, district = (F.col(c) for c in unit_shares)
    least = F.when(F.col("quality") <= 0.25, country).when(F.col("quality") <= 0.75, state).otherwise(district)
    fine = (F.coalesce(F.col("border_share"), F.lit(0.0)) < 0.6) & (F.col("area") >= 1) & ((F.col("presence") >= least) | (F.col("border_share") < 0))
    return q.select(zone, F.coalesce(fine, F.lit(False)).alias("use"))


def intensity(harvested: DataFrame, land: DataFrame, artefacts: DataFrame | None = None, zone: str = "zone") -> DataFrame:
    """cell, zone, intensity: harvested area of all source crops (null if all are) over crop land; null without crop land
    and in zones of ``artefacts``."""
    ha = harvested.groupBy("cell").agg(F.sum("area").alias("area"))
    out = land.join(ha, "cell", "left").withColumn("intensity", F.col("area") / F.when(F.col("cropland") > 0, F.col("cropland")))
    if artefacts is not None:
        out = out.join(artefacts.select(zone).distinct().withColumn("__bad", F.lit(True)), zone, "left").withColumn("intensity", F.when(F.col("__bad").isNull(), F.col("intensity"))).drop("__bad")
    return out.select("cell", zone, "intensity")


def hier_fill(cells: DataFrame, levels: Keys, value: str, weight: str) -> DataFrame:
    """Missing values from the weighted mean of the same district, else state, else country (``levels``, finest first).

    Only cells with a weight above 0 are filled; ``fill_level`` is 0 for own values, 1.. for the level, null where none is.
    """
    out = cells
    for k, level in enumerate(levels):
        known = F.when(F.col(value).isNotNull(), F.col(weight))
        mean = cells.groupBy(level).agg((F.sum(F.col(value) * F.col(weight)) / F.when(F.sum(known) > 0, F.sum(known))).alias(f"__{k}"))
        out = out.join(mean, level, "left")
    needs = F.col(value).isNull() & (F.col(weight) > 0)
    level = F.when(F.col(value).isNotNull(), 0)
    for k in range(len(levels)):
        level = level.when(needs & F.col(f"__{k}").isNotNull(), k + 1)
    filled = F.when(needs, F.coalesce(*(F.col(f"__{k}") for k in range(len(levels))))).otherwise(F.col(value))
    return out.withColumn("fill_level", level).withColumn(value, filled).drop(*(f"__{k}" for k in range(len(levels))))


def fill_stats(filled: DataFrame, zone: str, levels: int = 3) -> DataFrame:
    """Cells of each zone by the level they were filled from; ``failed``: still missing."""
    return filled.groupBy(zone).agg(*(F.count_if(F.col("fill_level") == k).alias(f"level{k}") for k in range(levels + 1)), F.count_if(F.col("fill_level").isNull()).alias("failed"))


def min_positive(df: DataFrame, keys: Keys, value: str, reference: int, year: str = "year") -> DataFrame:
    """The reference year's value, or where that is 0 or missing the smallest positive one of any year."""
    at = F.max(F.when(F.col(year) == reference, F.col(value)))
    return df.groupBy(*keys).agg(F.when(at > 0, at).otherwise(F.min(F.when(F.col(value) > 0, F.col(value)))).alias(value))


def presence_report(statistics: DataFrame, pattern: DataFrame, keys: Keys, accepted: DataFrame) -> DataFrame:
    """keys, both areas and status: both, statistics only, pattern accepted, or pattern rejected."""
    a, b = statistics.select(*keys, F.col("area").alias("stat_area")), pattern.select(*keys, F.col("area").alias("pattern_area"))
    both = a.join(b, [*keys], "full_outer").join(accepted.select(*keys).distinct().withColumn("__ok", F.lit(True)), [*keys], "left")
    s, p = F.coalesce(F.col("stat_area") > 0, F.lit(False)), F.coalesce(F.col("pattern_area") > 0, F.lit(False))
    status = F.when(s & p, "both").when(s, "statistics").when(p & F.col("__ok"), "pattern accepted").when(p, "pattern rejected").otherwise("none")
    return both.select(*keys, "stat_area", "pattern_area", status.alias("status"))


def refine_groups(df: DataFrame, groups: DataFrame, pattern: DataFrame, by: Keys) -> DataFrame:
    """A crop that the statistics know only as a group (``groups``: grp, crop) replaced by its parts, in the pattern's
    proportions; groups of which a part has statistics of its own, or without a pattern, stay. Returns by, crop, value."""
    own = df.filter("value is not null").select(*by, "crop").distinct()
    has_part = own.join(groups, "crop").select(*by, F.col("grp").alias("crop")).distinct()
    parts = groups.join(pattern, "crop").filter("area > 0")
    whole = F.sum("area").over(Window.partitionBy("country", "grp"))
    parts = parts.select("country", F.col("grp").alias("crop"), F.col("crop").alias("part"), (F.col("area") / whole).alias("share"))
    todo = df.join(has_part, [*by, "crop"], "left_anti").join(parts.select("country", "crop").distinct(), ["country", "crop"], "left_semi")
    made = todo.join(parts, ["country", "crop"]).select(*by, F.col("part").alias("crop"), (F.col("value") * F.col("share")).alias("value"))
    return df.join(todo.select(*by, "crop"), [*by, "crop"], "left_anti").select(*by, "crop", "value").unionByName(made)


def add_missing_crops(df: DataFrame, pattern: DataFrame, land: DataFrame, reference: int) -> DataFrame:
    """Crops that only the pattern has in a country: their area of the reference year, carried along crop land."""
    new = pattern.filter("area > 0").join(df.select("country", "crop").distinct(), ["country", "crop"], "left_anti")
    at = land.filter(F.col("year") == reference).select("country", F.col("cropland").alias("__ref"))
    made = new.join(land, "country").join(at, "country").select("country", "crop", "year", (F.col("area") * F.col("cropland") / F.when(F.col("__ref") > 0, F.col("__ref"))).alias("value"))
    return df.select("country", "crop", "year", "value").unionByName(made)


def borrow_mix(countries: DataFrame, group_of: DataFrame, values: DataFrame, members: DataFrame, land: DataFrame) -> DataFrame:
    """For countries without statistics the crop mix of their smallest group with data (``group_of``: country, grp), scaled
    by crop land. Returns country, crop, year, value."""
    v = values.filter("value is not null").join(members, "country")
    total = v.groupBy("grp", "crop", "year").agg(F.sum("value").alias("value"))
    base = v.select("grp", "country", "year").distinct().join(land, ["country", "year"]).groupBy("grp", "year").agg(F.sum("cropland").alias("base"))
    own = countries.join(group_of, "country").join(land, "country")
    out = own.join(total, ["grp", "year"]).join(base, ["grp", "year"])
    return out.select("country", "crop", "year", (F.col("value") * F.col("cropland") / F.when(F.col("base") > 0, F.col("base"))).alias("value"))
