"""Exact order statistics of a distributed column, by narrowing histograms."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
ENOUGH = 4096       # values that may be looked at one by one


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a double column (nulls and NaN left out).

    ``None`` if k < 1; the smallest value if there are fewer than k. Each round
    counts the values in ``BINS`` equal bins (pre-aggregated, so that at most
    that many rows reach the driver) and goes into the bin of the k-th.
    """
    values = df.where(F.col(column).isNotNull() & ~F.isnan(column)).select(F.col(column).alias("x"))
    row = values.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, lo, hi = row["n"], row["lo"], row["hi"]
    if k < 1 or not n:
        return None
    k = min(k, n)
    while True:
        inside = values.where((F.col("x") >= lo) & (F.col("x") <= hi))
        width = (hi - lo) / BINS
        if n <= ENOUGH or not math.isfinite(width) or lo + width <= lo or hi - width >= hi:
            counts = inside.groupBy("x").agg(F.count("*").alias("n")).orderBy(F.desc("x")).limit(ENOUGH).collect()
            for r in counts:
                k -= r["n"]
                if k <= 0:
                    return r["x"]
            return lo
        at = F.least(F.lit(BINS - 1), F.floor((F.col("x") - lo) / width))
        bins = inside.groupBy(at.alias("b")).agg(
            F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        for r in sorted(bins, key=lambda r: -r["b"]):
            if k <= r["n"]:
                n, lo, hi = r["n"], r["lo"], r["hi"]
                break
            k -= r["n"]
