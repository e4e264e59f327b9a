"""Roll-ups over overlapping groups and code sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_groups(df: DataFrame, membership: DataFrame, by: Sequence[str], value: str, flag: str | None = None, member: str = "country") -> DataFrame:
    """Sums over groups that may share members (null if all are null); the flag is set if any member's is."""
    aggs = [F.sum(value).alias(value)] + ([F.bool_or(flag).alias(flag)] if flag else [])
    return df.join(membership, member).groupBy("grp", *by).agg(*aggs)
