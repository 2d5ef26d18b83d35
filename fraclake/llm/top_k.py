"""The k-th largest value of a column, exactly, without sorting the column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges of one pass, and values few enough to be looked at one by one.
RANGES, FEW = 4096, 10_000


def kth_largest(df: DataFrame, column: str, k: int) -> float | int | None:
    """The value v with fewer than k values above it and k or more at or above it; None if there is none.

    Each pass counts the values in equal ranges between two bounds and goes on inside the
    range that holds the k-th; it ends when few values are left there, or only one value.
    """
    value = F.col(column)
    df = df.where(value.isNotNull())
    low, high, total = df.agg(F.min(value), F.max(value), F.count("*")).first()
    if k < 1 or total < k:
        return None
    inside = total
    while inside > FEW and low < high:
        width = (high - low) / RANGES
        part = F.least(F.lit(RANGES - 1), F.floor((value - low) / F.lit(width))).cast("int")
        counts = dict(df.where(value.between(low, high)).groupBy(part.alias("part")).agg(F.struct(F.count("*"), F.min(value), F.max(value))).collect())
        for at in sorted(counts, reverse=True):
            n, smallest, largest = counts[at]
            if n >= k:
                break
            k -= n
        inside, low, high = n, smallest, largest
    if low == high:
        return low
    rows = df.where(value.between(low, high)).select(value.alias("v")).orderBy(F.desc("v")).limit(FEW).collect()
    return rows[k - 1].v
