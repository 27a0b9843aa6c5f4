"""Month partitions of time-stamped tables, and pruning predicates for them.

A ledger or snapshot table stored as ``<table>/<ts>_month=YYYY-MM-01/...``
lets a report with a time bound read only the months it needs: Spark turns a
predicate on the partition column into partition pruning before any file is
opened. The reports call ``prune_months`` with their exact UTC bounds; it adds
the (superset) month predicate only when the column exists, so unpartitioned
tables behave as before and results never change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_column(ts: str) -> str:
    return f"{ts}_month"


def with_month(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Add ``<ts>_month``: first day of the UTC month of ``ts``."""
    return df.withColumn(month_column(ts), F.trunc(F.to_date(F.col(ts)), "month"))


def write_by_month(df: DataFrame, path: str, ts: str = "created_at",
                   mode: str = "errorifexists", max_records_per_file: int = 5_000_000) -> None:
    """Write ``df`` partitioned by the month of ``ts``.

    Every task writes the months it holds (no shuffle to gather a month into
    one task, which a busy month would skew); files are capped in rows.
    """
    (with_month(df, ts).write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(month_column(ts)).parquet(path))


def prune_months(df: DataFrame, ts: str, lo: dt.datetime | None = None,
                 hi: dt.datetime | None = None) -> DataFrame:
    """Keep the months that can hold ``lo <= ts`` and ``ts <= hi`` (or ``< hi``).

    A no-op unless ``df`` has the ``<ts>_month`` partition column; the exact
    time predicate stays with the caller.
    """
    col = month_column(ts)
    if col not in df.columns:
        return df
    if lo is not None:
        df = df.filter(F.col(col) >= F.lit(dt.date(lo.year, lo.month, 1)))
    if hi is not None:
        df = df.filter(F.col(col) <= F.lit(dt.date(hi.year, hi.month, 1)))
    return df
