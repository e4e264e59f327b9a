"""Exact medians of groups of any size in bounded memory.

Groups of few rows are sorted in their buffers, as usual. For large ones the median is closed in from both sides: mergeable
quantile sketches of bounded size give two neighbours of the wanted rank, counts tell what lies below and between them, and
only rows between them go on. What is left is few rows, or few distinct values, which are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.session import stored

#: Rows of a group that a task may hold, quantiles that a sketch is asked for, and its accuracy.
SMALL, STEPS, ACCURACY = 50_000, 512, 10_000
#: Large groups whose bounds are broadcast; more of them are joined by a shuffle.
BROADCAST = 100_000


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"__{k}"]) for k in keys))


def exact_medians(rows: DataFrame, keys: Sequence[str], value: str, small: int = SMALL) -> DataFrame:
    """keys, median, n: of the values that aren't null; groups without any have no row. Null keys are a group as well.

    As usual the median of an even number is the mean of the two in the middle. Whatever the sketches say, the result is
    exact: a bound that doesn't hold is dropped.
    """
    keys = list(keys)
    rows = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    plain = lambda df: df.groupBy(*keys).agg(F.median("__v").alias("median"), F.count(F.lit(1)).alias("n"))
    large = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > small))
    n_large = large.count()
    if not n_large:
        return plain(rows)
    sent = F.broadcast if n_large <= BROADCAST else (lambda df: df)
    # wanted: the ranks ``low`` and ``high`` among the rows between ``least`` and ``most``, of which there are ``inside``
    state = large.select(*(F.col(k).alias(f"__{k}") for k in keys), "n", F.lit(float("-inf")).alias("least"), F.lit(float("nan")).alias("most"),
                         F.floor((F.col("n") - 1) / 2).alias("low"), F.floor(F.col("n") / 2).alias("high"), F.col("n").alias("inside"), F.lit(True).alias("going"))
    names = state.columns
    few = sent(state.select(*(f"__{k}" for k in keys)))
    rest = plain(rows.join(few, _same(rows, few, keys), "left_anti"))
    between = (F.col("__v") >= F.col("least")) & (F.col("__v") <= F.col("most"))  # nan is the largest of all
    while True:
        open_groups = sent(state.filter("going"))
        inside = rows.join(open_groups, _same(rows, open_groups, keys)).filter(between)
        # ranks among the rows inside, as places in the sketch with one more on either side
        sketch = inside.groupBy(*(c for c in names)).agg(F.percentile_approx("__v", F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1))), ACCURACY).alias("q"))
        at = lambda rank, more: F.greatest(F.lit(1), F.least(F.lit(STEPS + 1), F.floor(rank / F.col("inside") * STEPS) + 1 + more)).cast("int")
        closer = sketch.select(*names, F.get(F.col("q"), at(F.col("low"), -1) - 1).alias("a"), F.get(F.col("q"), at(F.col("high"), 2) - 1).alias("b"))
        closer = sent(stored(closer))
        counted = rows.join(closer, _same(rows, closer, keys)).filter(between).groupBy(*names, "a", "b")
        counted = counted.agg(F.count_if(F.col("__v") < F.col("a")).alias("below"), F.count_if((F.col("__v") >= F.col("a")) & (F.col("__v") <= F.col("b"))).alias("left"))
        holds = (F.col("below") <= F.col("low")) & (F.col("high") < F.col("below") + F.col("left"))
        further = holds & (F.col("left") < F.col("inside"))
        new = {"least": F.when(holds, F.col("a")).otherwise(F.col("least")), "most": F.when(holds, F.col("b")).otherwise(F.col("most"))}
        new |= {c: F.when(holds, F.col(c) - F.col("below")).otherwise(F.col(c)) for c in ("low", "high")}
        new |= {"inside": F.when(holds, F.col("left")).otherwise(F.col("inside")), "going": further & (F.col("left") > small)}
        moved = counted.select(*(new.get(c, F.col(c)).alias(c) for c in names))
        state = stored(moved.unionByName(state.filter("not going")))
        if state.filter("going").isEmpty():
            break
    bounds = sent(state)
    values = rows.join(bounds, _same(rows, bounds, keys)).filter(between).groupBy(*names, "__v").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy(*(f"__{k}" for k in keys)).orderBy("__v"))
    ranked = values.withColumn("upto", upto)
    first = lambda rank: F.min(F.when(F.col("upto") > F.col(rank), F.col("__v")))
    found = ranked.groupBy(*names).agg(((first("low") + first("high")) / 2).alias("median"))
    return rest.unionByName(found.select(*(F.col(f"__{k}").alias(k) for k in keys), "median", "n"))
