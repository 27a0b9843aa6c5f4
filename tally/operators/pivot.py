"""Pivot over a closed list of keys.

Replaces ``jsonb_object_agg(key, value)`` followed by ``->> 'key'`` lookups:
one conditional sum per key in a single aggregate (one shuffle, partial
aggregation map-side), typed columns instead of a JSON object. A key absent
from a group gives NULL, as a missing JSON key does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sums(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
               measure: Column, names: Sequence[str] | None = None) -> DataFrame:
    names = list(names or values)
    aggs = [F.sum(F.when(F.col(pivot_col) == F.lit(v), measure)).alias(n)
            for v, n in zip(values, names)]
    return df.groupBy(*keys).agg(*aggs)
