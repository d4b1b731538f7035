"""Exact quantiles of a column by counting, so that no task holds its values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a pass / values of the last bin that are fetched.
BINS, FEW = 4096, 4096


def value_at(df: DataFrame, column: str, rank: int) -> float:
    """The value of a place (from 0) in ascending order of the non-null values.

    Each pass counts the values in bins between the bounds known so far and goes on in the bin of the place, whose own least and largest
    value are the next bounds; the driver gets a row a bin. It ends with one value, or with few enough to be fetched.
    """
    x = F.col(column)
    own = df.where(x.isNotNull()).select(x.cast("double").alias("v"))
    low, high, below = *own.agg(F.min("v"), F.max("v")).first(), 0
    while low < high:
        width = (high - low) / BINS
        part = own.where(F.col("v").between(low, high))
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1)) if width > 0 else (F.col("v") > low).cast("long")
        for _, n, low, high in sorted(part.groupBy(place.alias("bin")).agg(F.count("*"), F.min("v"), F.max("v")).collect()):  # noqa: B007
            if below + n > rank:
                break
            below += n
        if n <= FEW:
            return sorted(r["v"] for r in own.where(F.col("v").between(low, high)).collect())[rank - below]
    return low


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """The quantiles with linear interpolation between values; None for a column without values."""
    n = df.where(F.col(column).isNotNull()).count()
    if not n:
        return [None] * len(shares)
    ranks = {r for p in shares for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    at = {r: value_at(df, column, r) for r in sorted(ranks)}
    out = []
    for p in shares:
        place = p * (n - 1)
        a, b = at[math.floor(place)], at[math.ceil(place)]
        out.append(a + (place - math.floor(place)) * (b - a))
    return out
