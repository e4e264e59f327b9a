"""Unit conversion over the closed set of units that the inputs use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dimension of a unit and its size in the dimension's base unit.
UNITS = {
    "m2": ("area", 1.0), "ha": ("area", 1e4), "1000 ha": ("area", 1e7), "km2": ("area", 1e6),
    "g": ("mass", 1e-3), "kg": ("mass", 1.0), "t": ("mass", 1e3), "hg": ("mass", 0.1),
    "kg/m2": ("load", 1.0), "g/m2": ("load", 1e-3), "kg/ha": ("load", 1e-4), "kg/km2": ("load", 1e-6), "t/ha": ("load", 0.1), "hg/ha": ("load", 1e-5),
    "m3": ("volume", 1.0), "km3": ("volume", 1e9), "1e6 m3": ("volume", 1e6),
    "1": ("share", 1.0), "%": ("share", 0.01),
}


def factor(source: str, target: str) -> float:
    """What a value in ``source`` is multiplied by to be in ``target``; an error if they can't be converted."""
    for u in (source, target):
        if u not in UNITS:
            raise ValueError(f"unknown unit {u!r}")
    if UNITS[source][0] != UNITS[target][0]:
        raise ValueError(f"{source} is no {UNITS[target][0]}")
    return UNITS[source][1] / UNITS[target][1]


def convert(value: Column | str, source: str, target: str) -> Column:
    return (F.col(value) if isinstance(value, str) else value) * F.lit(factor(source, target))


def convert_by_row(df: DataFrame, value: str, unit: str, target: str) -> DataFrame:
    """``value`` in the unit that column ``unit`` names, converted to ``target``; an unknown unit raises."""
    expr = F.when(F.col(value).isNull(), F.lit(None).cast("double"))
    for u in UNITS:
        if UNITS[u][0] == UNITS[target][0]:
            expr = expr.when(F.col(unit) == u, F.col(value) * F.lit(factor(u, target)))
    return df.withColumn(value, expr.otherwise(F.raise_error(F.concat(F.lit("can't be converted: "), F.coalesce(unit, F.lit("null")))).cast("double"))).withColumn(unit, F.lit(target))
