"""Yearly series: densification, interpolation, filling with a proxy, lifetimes, reference years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def densify(df: DataFrame, keys: Keys, year: str = "year", lo: int | None = None, hi: int | None = None) -> DataFrame:
    """A row for every year between each key's first and last one, or from ``lo`` to ``hi``; new rows are null elsewhere."""
    bounds = df.groupBy(*keys).agg(F.min(year).alias("__lo"), F.max(year).alias("__hi"))
    first = F.col("__lo") if lo is None else F.lit(lo)
    last = F.col("__hi") if hi is None else F.lit(hi)
    years = bounds.select(*keys, F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias(year))
    return years.join(df, [*keys, year], "left")


def _ends(keys: Keys, year: str, known: Column) -> tuple[Column, Column]:
    """Last year with a value up to this one, and next year with a value from this one on."""
    w = Window.partitionBy(*keys).orderBy(year)
    a = F.last(F.when(known, F.col(year)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first(F.when(known, F.col(year)), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return a, b


def interpolate(df: DataFrame, keys: Keys, value: str, year: str = "year") -> DataFrame:
    """Interior gaps filled linearly; nothing before the first or after the last value."""
    w = Window.partitionBy(*keys).orderBy(year)
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    a, b = _ends(keys, year, F.col(value).isNotNull())
    out = df.withColumn("__a", a).withColumn("__b", b).withColumn("__va", F.last(value, ignorenulls=True).over(before)).withColumn("__vb", F.first(value, ignorenulls=True).over(after))
    line = F.col("__va") + (F.col("__vb") - F.col("__va")) * (F.col(year) - F.col("__a")) / F.when(F.col("__b") > F.col("__a"), F.col("__b") - F.col("__a"))
    return out.withColumn(value, F.coalesce(F.col(value), line)).drop("__a", "__b", "__va", "__vb")


def fill_series(df: DataFrame, keys: Keys, value: str, proxy: str, year: str = "year", extend: bool = True) -> DataFrame:
    """Gaps of ``value`` filled along ``proxy``; every year has a row (see densify) and the proxy its own gaps filled.

    Inside, value / proxy is interpolated between both ends of a gap and multiplied by the proxy; where only one end has
    a positive proxy the line between the ends holds on the other side of the gap's first or last positive proxy; without
    any proxy the line holds throughout. Before the first and after the last value the ratio stays constant (``extend``).
    """
    w = Window.partitionBy(*keys).orderBy(year)
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    known = F.col(value).isNotNull()
    a, b = _ends(keys, year, known)
    # a sentinel keeps a null proxy at the end from being skipped
    end_proxy = F.when(known, F.coalesce(F.col(proxy), F.lit(-1.0)))
    df = df.withColumn("__a", a).withColumn("__b", b).withColumn("__ha", F.last(value, ignorenulls=True).over(before)).withColumn("__hb", F.first(value, ignorenulls=True).over(after))
    df = df.withColumn("__ca", F.last(end_proxy, ignorenulls=True).over(before)).withColumn("__cb", F.first(end_proxy, ignorenulls=True).over(after))
    gap = Window.partitionBy(*keys, "__a", "__b")
    positive = F.when(~known & (F.col(proxy) > 0), F.col(year))
    df = df.withColumn("__first", F.min(positive).over(gap)).withColumn("__last", F.max(positive).over(gap))
    y, c = F.col(year), F.col(proxy)
    ha, hb, ca, cb, ya, yb = (F.col(f"__{x}") for x in ("ha", "hb", "ca", "cb", "a", "b"))
    first, last = F.col("__first"), F.col("__last")
    span = F.when(yb > ya, yb - ya)
    line = lambda at: ha + (hb - ha) * (at - ya) / span
    ratio = lambda h, p: h / F.when(p > 0, p)

    def along(fa: Column, fb: Column, t0: Column, t1: Column) -> Column:
        return (fa + (fb - fa) * (y - t0) / F.when(t1 > t0, t1 - t0)) * c

    proxy_at = lambda at: F.max(F.when(y == at, c)).over(gap)
    df = df.withColumn("__cfirst", proxy_at(first)).withColumn("__clast", proxy_at(last))
    ok_a, ok_b, some = ca > 0, cb > 0, first.isNotNull()
    inside = (
        F.when(~some | (~ok_a & ~ok_b), line(y))
        .when(ok_a & ok_b, along(ratio(ha, ca), ratio(hb, cb), ya, yb))
        .when(ok_a, F.when(y >= last, line(y)).otherwise(along(ratio(ha, ca), ratio(line(last), F.col("__clast")), ya, last)))
        .otherwise(F.when(y <= first, line(y)).otherwise(along(ratio(line(first), F.col("__cfirst")), ratio(hb, cb), first, yb)))
    )
    lead = F.when(ok_b & some, c * ratio(hb, cb)) if extend else F.lit(None).cast("double")
    trail = F.when(ok_a & some, c * ratio(ha, ca)) if extend else F.lit(None).cast("double")
    filled = F.when(known, F.col(value)).when(ya.isNull(), lead).when(yb.isNull(), trail).otherwise(inside)
    gone = [x for x in df.columns if x.startswith("__")]
    return df.withColumn(value, filled).drop(*gone)


def fill_series_chain(df: DataFrame, keys: Keys, value: str, proxies: Keys, year: str = "year") -> DataFrame:
    """Filled with the first proxy, what is left with the next; ``is_filled`` marks what wasn't given."""
    df = df.withColumn("_given", F.col(value).isNotNull())
    for p in proxies:
        df = fill_series(df, keys, value, p, year)
    return df.withColumn("is_filled", F.col(value).isNotNull() & ~F.col("_given")).drop("_given")


def annualise(df: DataFrame, keys: Keys, value: str, split_year: int, year: str = "year") -> DataFrame:
    """Slices up to ``split_year`` interpolated to every year; later ones as they are."""
    early = interpolate(densify(df.filter(F.col(year) <= split_year), keys, year), keys, value, year)
    return early.unionByName(df.filter(F.col(year) > split_year).select(*early.columns))


def relative_to(df: DataFrame, keys: Keys, value: str, reference: int, year: str = "year") -> DataFrame:
    """Values divided by the reference year's; null where that is 0 or missing."""
    at = F.max(F.when(F.col(year) == reference, F.col(value))).over(Window.partitionBy(*keys))
    return df.withColumn(value, F.col(value) / F.when(at != 0, at))


def apply_lifetime(df: DataFrame, lifetimes: DataFrame, key: str, value: str, year: str = "year") -> DataFrame:
    """Null before an entity's start, and after its end if a successor has data."""
    with_data = df.select(F.col(key).alias("__successor")).distinct()
    heirs = lifetimes.filter("parent is not null").join(with_data, lifetimes[key] == F.col("__successor"), "left_semi").select(F.col("parent").alias(key)).distinct().withColumn("__heir", F.lit(True))
    out = df.join(lifetimes.select(key, "start_year", "end_year"), key, "left").join(heirs, key, "left")
    gone = (F.col(year) < F.col("start_year")) | ((F.col(year) > F.col("end_year")) & F.col("__heir"))
    return out.withColumn(value, F.when(F.coalesce(gone, F.lit(False)), None).otherwise(F.col(value))).drop("start_year", "end_year", "__heir")


def successor_sum(df: DataFrame, lifetimes: DataFrame, key: str, value: str, others: Keys = (), year: str = "year") -> DataFrame:
    """(parent, others, year, value, complete): the successors' sum (null if all are) and whether all have a value."""
    children = lifetimes.filter("parent is not null").select(key, "parent")
    size = children.groupBy("parent").agg(F.count(F.lit(1)).alias("__n"))
    out = df.join(children, key).groupBy("parent", *others, year).agg(F.sum(value).alias(value), F.count(value).alias("__have"))
    return out.join(size, "parent").select("parent", *others, year, value, (F.col("__have") == F.col("__n")).alias("complete"))


def extend_flat(df: DataFrame, keys: Keys, value: str, year: str = "year") -> DataFrame:
    """The first value before it, the last one after it; interior gaps stay."""
    w = Window.partitionBy(*keys).orderBy(year)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(value, F.when(F.col(value).isNotNull(), F.col(value)).when(back.isNull(), ahead).when(ahead.isNull(), back))


def top1(df: DataFrame, keys: Keys, order: Sequence[Column], cols: Keys) -> DataFrame:
    """The row of each key with the largest ``order``; a map-side aggregate, no window."""
    best = F.max_by(F.struct(*cols), F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__best.{c}").alias(c) for c in cols))


def smallest_group(members: DataFrame, with_data: DataFrame) -> DataFrame:
    """country and grp: of its groups that have data, the one with the fewest members, then the first by name."""
    sized = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).join(with_data.select("grp").distinct(), "grp", "left_semi")
    return members.join(sized, "grp").groupBy("country").agg(F.min_by("grp", F.struct("size", "grp")).alias("grp"))
