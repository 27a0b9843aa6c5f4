"""Newest / oldest row per key (Postgres ``DISTINCT ON (k) ... ORDER BY k, t``).

The window form ``row_number() over (partition by k order by ...) = 1`` is
planned by Spark as a partial ``WindowGroupLimit`` before the shuffle and a
final one after it, so each map task forwards at most one row per key: a key
holding a third of all rows costs one row per input split on the wire, not a
third of the table in one task.

Postgres sorts NULLs last ascending and first descending; Spark's defaults
are the reverse, so every ordering is spelled out through ``newest`` /
``oldest``. A unique tie-break must end the ordering: ``DISTINCT ON`` leaves
ties undefined, a report must not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__tally_rn"


def newest(c: Column | str) -> Column:
    """Postgres ``c DESC``: NULLs first."""
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def oldest(c: Column | str) -> Column:
    """Postgres ``c ASC``: NULLs last."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (the whole row survives)."""
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def first_value_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                        earliest: bool = True, alias: str | None = None) -> DataFrame:
    """``DISTINCT ON (k) k, ts ORDER BY k, ts ASC|DESC`` when only ``ts`` is kept.

    Ascending (NULLs last) picks ``min(ts)``, and an all-NULL key gets NULL,
    which is exactly ``min``. Descending (NULLs first) picks NULL as soon as
    one row has a NULL ``ts``, else ``max``. A plain aggregate does it, with
    map-side partial aggregation and no sort.
    """
    c = F.col(ts)
    if earliest:
        value = F.min(c)
    else:
        value = F.when(F.count(F.lit(1)) == F.count(c), F.max(c))
    return df.groupBy(*keys).agg(value.alias(alias or ts))


def latest_facts(df: DataFrame, key: str, ts: str, facts: Sequence[str],
                 tiebreak: Sequence[str]) -> DataFrame:
    """Newest row per key, of which only the key, ``ts`` and ``facts`` are wanted.

    Ties end with the (unique) ``tiebreak`` columns if the table has them all,
    else with the facts themselves: rows alike in all of them give one result.
    No other column is read, sorted by or shuffled.
    """
    ends = list(tiebreak) if all(c in df.columns for c in tiebreak) else sorted(facts)
    rows = df.select(*dict.fromkeys([key, ts, *facts, *ends]))
    return latest_per_key(rows, [key], [newest(c) for c in (ts, *ends)])


def tiebreak_columns(df: DataFrame, preferred: Sequence[str],
                     exclude: Sequence[str] = ()) -> list[str]:
    """Columns that finish an ordering deterministically.

    The preferred (unique) columns when the table has them all; otherwise
    every other column, by name, so only fully identical rows still tie.
    """
    if all(c in df.columns for c in preferred):
        return list(preferred)
    return sorted(c for c in df.columns if c not in set(exclude))
