"""Fitting values to capacities: reconciliation, scaling, bounding, shifting, disaggregation, redistribution, bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from gridprep.session import stored

Keys = Sequence[str]


def reconcile_parts(df: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Crop land as the sum of rainfed and irrigated: a shortage goes to rainfed, rainfed stops at the total, irrigated
    takes the cut; ``both_over`` marks cells where each part alone is above the total by more than the tolerance."""
    total, rf, ir = F.col("cropland"), F.coalesce("rainfed", F.lit(0.0)), F.coalesce("irrigated", F.lit(0.0))
    both = (rf > total + tolerance) & (ir > total + tolerance)
    rf = F.when(rf + ir < total, total - ir).otherwise(rf)
    rf = F.least(rf, total)
    return df.withColumn("both_over", F.coalesce(both, F.lit(False))).withColumn("__rf", rf).withColumn("irrigated", F.greatest(F.least(ir, total - F.col("__rf")), F.lit(0.0))).withColumn("rainfed", F.col("__rf")).drop("__rf")


def capacities(df: DataFrame, by: Keys) -> DataFrame:
    """Sums of crop land times suitability: irrigated, rainfed, irrigated land under rainfed suitability, total."""
    ir, rf = F.col("irrigated"), F.col("rainfed")
    return df.groupBy(*by).agg(
        F.sum(ir * F.col("suit_ir")).alias("ir_cap"), F.sum(rf * F.col("suit_rf")).alias("rf_cap_rf"), F.sum(ir * F.col("suit_rf")).alias("rf_cap_ir"),
        F.sum(ir * F.col("suit_ir") + rf * F.col("suit_rf")).alias("total_cap"),
    )


def scale_to_cap(df: DataFrame, by: Keys, value: str, cap: str) -> DataFrame:
    """All values of a group scaled down where their sum is above ``cap``; a capacity of 0 gives 0. Adds the share lost
    and keeps the unconstrained value as ``free_value``."""
    total = F.sum(value).over(Window.partitionBy(*by))
    share = F.when(F.col(cap) <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.col(cap) / F.when(total > 0, total), F.lit(1.0))))
    return df.withColumn("free_value", F.col(value)).withColumn("__share", share).withColumn(value, F.col(value) * F.col("__share")).withColumn("lost", 1 - F.col("__share")).drop("__share")


def bound_by(part: str, whole: str):
    """The part, at most the whole; 0 where the whole is missing."""
    return F.when(F.col(whole).isNull(), F.lit(0.0)).otherwise(F.when(F.col(part) > F.col(whole), F.col(whole)).otherwise(F.col(part)))


def shift_to_irrigated(df: DataFrame, by: Keys = ("country",)) -> DataFrame:
    """Moves what doesn't fit rainfed to irrigated: crops with irrigation first, in proportion, then purely rainfed ones.

    ``df``: keys, crop, rainfed, irrigated, and the group's ir_cap, rf_cap_rf, rf_cap_ir.
    """
    w = Window.partitionBy(*by)
    rf, total = F.sum("rainfed").over(w), F.sum(F.col("rainfed") + F.col("irrigated")).over(w)
    on_irrigated = total - F.col("rf_cap_rf")
    spread = F.col("ir_cap") - F.col("rf_cap_ir")
    room = F.col("rf_cap_rf") + F.col("rf_cap_ir") * (F.col("ir_cap") - on_irrigated) / F.when(spread != 0, spread)
    need = F.greatest(F.coalesce(rf - room, F.lit(0.0)), F.lit(0.0))
    with_ir = F.sum(F.when(F.col("irrigated") > 0, F.col("rainfed")).otherwise(0.0)).over(w)
    without = F.sum(F.when(F.col("irrigated") > 0, 0.0).otherwise(F.col("rainfed"))).over(w)
    df = df.withColumn("__need", F.least(need, rf)).withColumn("__with", with_ir).withColumn("__without", without)
    first = F.least("__need", "__with")
    rest = F.col("__need") - first
    moved = F.when(F.col("irrigated") > 0, F.coalesce(F.col("rainfed") * first / F.when(F.col("__with") > 0, F.col("__with")), F.lit(0.0))).otherwise(F.coalesce(F.col("rainfed") * rest / F.when(F.col("__without") > 0, F.col("__without")), F.lit(0.0)))
    df = df.withColumn("shifted", moved)
    return df.withColumn("rainfed", F.col("rainfed") - F.col("shifted")).withColumn("irrigated", F.col("irrigated") + F.col("shifted")).drop("__need", "__with", "__without")


def disaggregate(totals: DataFrame, cells: DataFrame, country: str = "country", crop: str = "crop", others: Keys = ()) -> DataFrame:
    """Totals spread over a country's cells by pattern times crop land; by crop land where that is 0 everywhere.

    ``totals``: country, crop, total; ``cells``: cell, country, crop, pattern, cropland (pattern null where unknown).
    """
    w = Window.partitionBy(country, crop, *others)
    own = F.coalesce(F.col("pattern"), F.lit(0.0)) * F.col("cropland")
    df = cells.join(totals, [country, crop, *others]).withColumn("__own", own)
    by_pattern, by_land = F.sum("__own").over(w), F.sum("cropland").over(w)
    weight = F.when(by_pattern > 0, F.col("__own") / F.when(by_pattern > 0, by_pattern)).otherwise(F.col("cropland") / F.when(by_land > 0, by_land))
    return df.withColumn("area", F.col("total") * weight).drop("__own")


def cut_to_capacity(df: DataFrame, by: Keys = ("country",)) -> DataFrame:
    """A round's first half: the areas of cells over their capacity cut in proportion; ``overflow`` is what was cut."""
    used = F.sum("area").over(Window.partitionBy(*by, "cell"))
    cut = F.when(used > F.col("cap"), F.col("area") * F.col("cap") / F.when(used > 0, used)).otherwise(F.col("area"))
    return df.withColumn("__cut", cut).withColumn("overflow", F.col("area") - F.col("__cut")).withColumn("area", F.col("__cut")).drop("__cut")


#: Crops of all groups up to which their table, a row for each group, is broadcast.
SMALL = 1_000_000
#: Rounds whose finished groups are kept as tables of their own.
ASIDE = 16


def redistribute(alloc: DataFrame, by: Keys = ("country",), max_rounds: int = 1000, tolerance: float = 1e-4, outside_after: int = 20) -> DataFrame:
    """Areas that fit each cell's capacity and keep each crop's total in a group, as far as the group has room.

    ``alloc``: keys, cell, crop, area, cap. Every round cuts cells to their capacity and grows, in logistic steps of the
    filling, cells with room where a crop is short. A crop whose own cells have less room left than it is short, or that
    is still short after ``outside_after`` rounds, also enters cells it isn't in, linearly by free space. All groups run together, and one that is done
    doesn't change any more. Adds ``rounds``, the group's rounds of growth, and ``settled``: false if a crop of the group
    is still short after ``max_rounds``.

    A cell is one row with its crops in an array, so only the crops' sums are shuffled in a round, and only their number
    reaches the driver. A round's lineage is cut once, with the cells; groups that are done leave the loop.
    """
    keys = list(by)
    total = alloc.groupBy(*keys, "crop").agg(F.sum("area").alias("total"))
    room = alloc.groupBy(*keys, "cell").agg(F.max("cap").alias("cap")).groupBy(*keys).agg(F.sum("cap").alias("room"))
    targets = total.join(room, keys).withColumn("__all", F.sum("total").over(Window.partitionBy(*keys)))
    target = F.when(F.col("__all") > F.col("room"), F.col("total") * F.col("room") / F.when(F.col("__all") > 0, F.col("__all"))).otherwise(F.col("total"))
    targets = stored(targets.select(*keys, "crop", target.alias("target")))
    state = alloc.groupBy(*keys, "cell").agg(F.max("cap").cast("double").alias("cap"), F.sort_array(F.collect_list(F.struct("crop", F.col("area").cast("double").alias("area")))).alias("crops"))
    state = stored(state.withColumn("rounds", F.lit(0)).withColumn("open", F.lit(True)))
    aside: list[DataFrame] = []

    def added(array, value):
        return F.aggregate(array, F.lit(0.0), lambda a, x: a + value(x))

    def fitted(df: DataFrame) -> DataFrame:
        """Crops cut to the cell's capacity, and its free space."""
        df = df.withColumn("used", added(F.col("crops"), lambda c: c["area"]))
        share = F.when(F.col("used") > F.col("cap"), F.col("cap") / F.when(F.col("used") > 0, F.col("used"))).otherwise(F.lit(1.0))
        df = df.withColumn("crops", F.transform("crops", lambda c: F.struct(c["crop"].alias("crop"), (c["area"] * share).alias("area"))))
        return df.withColumn("free", F.greatest(F.col("cap") - F.col("used"), F.lit(0.0))).drop("used")

    for n in range(max_rounds + 1):
        now = fitted(state)
        have = now.select(*keys, "free", F.explode("crops").alias("c")).groupBy(*keys, "c.crop")
        have = have.agg(F.sum("c.area").alias("have"), F.sum(F.when(F.col("c.area") > 0, F.col("free")).otherwise(0.0)).alias("near"), F.sum("free").alias("any"))
        gap = have.join(targets, [*keys, "crop"]).withColumn("short", F.greatest(F.col("target") - F.col("have"), F.lit(0.0)))
        gap = gap.withColumn("open", F.col("short") > F.greatest(F.col("target") * tolerance, F.lit(1e-9)))
        # room in a crop's own cells only shrinks, so one with too little is never done there
        gap = gap.withColumn("leaves", F.col("open") & ((F.col("near") < F.col("short")) | F.lit(n >= outside_after)))
        by_group = gap.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("crop", F.struct("short", "near", "any", "leaves")))).alias("gaps"), F.bool_or("open").alias("open"))
        seen = Observation()
        by_group = stored(by_group.observe(seen, F.sum(F.size("gaps")).alias("n"), F.count_if("open").alias("open")))
        joined = now.drop("open").join(F.broadcast(by_group) if (seen.get["n"] or 0) <= SMALL else by_group, keys)
        if not seen.get["open"] or n == max_rounds:
            state = joined.drop("gaps", "free")
            break
        # crops that leave their cells enter every cell of their group
        absent = F.filter(F.map_keys("gaps"), lambda k: F.col("gaps")[k]["leaves"] & ~F.exists("crops", lambda c: c["crop"] == k))
        joined = joined.withColumn("crops", F.concat("crops", F.transform(absent, lambda k: F.struct(k.alias("crop"), F.lit(0.0).alias("area")))))

        def growth(c):
            # growth slows as the cell fills
            g, free = F.col("gaps")[c["crop"]], F.col("free")
            inside = F.when((c["area"] > 0) & (g["near"] > 0), free / F.when(g["near"] > 0, g["near"]))
            anywhere = F.when((g["any"] > 0) & g["leaves"], free / F.when(g["any"] > 0, g["any"]))
            return g["short"] * F.coalesce(anywhere, inside, F.lit(0.0))

        joined = joined.withColumn("grown", F.transform("crops", growth))
        joined = joined.withColumn("wanted", added(F.col("grown"), lambda g: g))
        part = F.when(F.col("wanted") > F.col("free"), F.col("free") / F.when(F.col("wanted") > 0, F.col("wanted"))).otherwise(F.lit(1.0))
        more = F.zip_with("crops", "grown", lambda c, g: F.struct(c["crop"].alias("crop"), (c["area"] + g * part).alias("area")))
        state = joined.withColumn("crops", F.when(F.col("open"), more).otherwise(F.col("crops"))).withColumn("rounds", F.col("rounds") + F.col("open").cast("int")).select(*keys, "cell", "cap", "crops", "rounds", "open")
        state = stored(state)
        aside.append(state.filter("not open"))
        if len(aside) == ASIDE:
            # many rounds: what is done becomes one table, so the plan at the end stays short
            aside = [stored(reduce(DataFrame.unionByName, aside))]
        state = state.filter("open")
    for done in aside:
        state = state.select(*keys, "cell", "cap", "crops", "rounds", "open").unionByName(done)
    out = state.select(*keys, "cell", "cap", "rounds", (~F.col("open")).alias("settled"), F.explode("crops").alias("c"))
    return out.select(*keys, "cell", "c.crop", "c.area", "cap", "rounds", "settled")


def redistribution_report(before: DataFrame, after: DataFrame, by: Keys = ("country",)) -> DataFrame:
    """Per keys and crop: total before, placed after, moved (area gained by cells), outside (area now in cells without the
    crop before, the emergency moves), cells_outside (their number), and the group's rounds if ``after`` has them."""
    keys = [*by, "crop"]
    a = before.select(*keys, "cell", F.col("area").alias("__before"))
    rounds = F.col("rounds") if "rounds" in after.columns else F.lit(None).cast("int").alias("rounds")
    b = after.select(*keys, "cell", F.col("area").alias("__after"), rounds)
    both = a.join(b, [*keys, "cell"], "full_outer").fillna(0.0, ["__before", "__after"])
    outside = (F.col("__before") == 0) & (F.col("__after") > 0)
    return both.groupBy(*keys).agg(
        F.sum("__before").alias("total"), F.sum("__after").alias("placed"), F.sum(F.greatest(F.col("__after") - F.col("__before"), F.lit(0.0))).alias("moved"),
        F.sum(F.when(outside, F.col("__after")).otherwise(0.0)).alias("outside"), F.count_if(outside).alias("cells_outside"), F.max("rounds").alias("rounds"),
    )


def build_bands(crops: DataFrame, mapping: DataFrame, land: DataFrame) -> DataFrame:
    """cell, band, area: crop areas by the mapping's bands, scaled down to the cell's crop land, and fallow as a band.

    ``crops``: cell, crop, area; ``mapping``: crop, band; ``land``: cell, cropland. Nothing where there is no crop land.
    """
    bands = crops.join(mapping, "crop").groupBy("cell", "band").agg(F.sum("area").alias("area")).join(land, "cell").filter("cropland > 0")
    used = F.sum("area").over(Window.partitionBy("cell"))
    bands = bands.withColumn("__used", F.coalesce(used, F.lit(0.0))).withColumn("area", F.coalesce(F.col("area") * F.least(F.lit(1.0), F.col("cropland") / F.when(F.col("__used") > 0, F.col("__used"))), F.lit(0.0)))
    sums = bands.groupBy("cell").agg(F.sum("area").alias("__sum"))
    fallow = land.filter("cropland > 0").join(sums, "cell", "left").select("cell", F.lit("fallow").alias("band"), F.greatest(F.col("cropland") - F.coalesce("__sum", F.lit(0.0)), F.lit(0.0)).alias("area"))
    return bands.select("cell", "band", "area").unionByName(fallow)
