"""Theta anti-join against a later void of the same transaction.

The reports write it as ``ledger LEFT JOIN (one void per transaction) v ON
id = v.id AND created_at < v.created_at WHERE v.id IS NULL``. Spark keeps
that shape as an outer join plus a filter, so it is written here as a
``left_anti`` join, which drops a row exactly when a void exists for its key
and the row's ``created_at`` is known and earlier (a NULL comparison keeps
the row, as in the outer-join form).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tally.operators.latest import first_value_per_key

VOID_AT = "__tally_void_at"


def void_cutoffs(voids: DataFrame, key: str, ts: str, latest: bool = True) -> DataFrame:
    """One cutoff per key: the latest void (``DESC``) or the earliest (``ASC``)."""
    return (first_value_per_key(voids.select(key, ts), [key], ts,
                                earliest=not latest, alias=VOID_AT)
            .withColumnRenamed(key, "__tally_void_key"))


def without_earlier_than(df: DataFrame, cutoffs: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of ``df`` not strictly earlier than their key's cutoff."""
    cond: Column = ((df[key] == cutoffs["__tally_void_key"])
                    & (df[ts] < cutoffs[VOID_AT]))
    return df.join(cutoffs, cond, "left_anti")
