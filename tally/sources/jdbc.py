"""Report input tables straight from a JDBC database (e.g. Postgres).

Each table is read as ``slices`` parallel queries, one per hash bucket of the
table's key computed inside the database, so no single task pulls a whole
table over one connection and the buckets partition the rows exactly (every
row falls in one bucket; a NULL key goes to bucket 0). The bucket expression
is database-specific; the default is Postgres's ``hashtext``.

Not exercised against a live database in this repository (none may be
started here); the slice predicates are unit-tested.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Key column used to slice each table (its primary key, or the key reports join on).
SLICE_KEYS = {
    "ledger": "transaction_id",
    "loan_snapshots": "loan_id",
    "acceleration_events": "loan_id",
    "loan_principal_adjustment": "loan_id",
    "investor_purchases": "loan_id",
    "payment_statuses": "payment_slug",
    "ledger_entries": "ledger_transaction_id",
    "ledger_accounts": "name",
}

# ((h % n) + n) % n is in [0, n) for any 32-bit h; abs(h) would overflow on
# the smallest hash value.
POSTGRES_BUCKET = "((hashtext(coalesce({key}::text, '')) % {n}) + {n}) % {n}"


def slice_predicates(key: str, slices: int, bucket: str = POSTGRES_BUCKET) -> list[str]:
    """One WHERE clause per slice; together they cover every row exactly once."""
    if slices <= 1:
        return ["1 = 1"]
    expr = bucket.format(key=key, n=slices)
    return [f"{expr} = {i}" for i in range(slices)]


class JdbcTables(dict):
    """``name -> DataFrame`` read lazily from a JDBC source, in parallel slices."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str],
                 slices: int, table_names: Mapping[str, str], bucket: str,
                 names: Iterable[str] | None):
        super().__init__()
        self._spark, self._url, self._props = spark, url, dict(properties)
        self._slices, self._table_names, self._bucket = slices, dict(table_names), bucket
        self._names = set(names) if names is not None else None

    def __missing__(self, name: str) -> DataFrame:
        if self._names is not None and name not in self._names:
            raise KeyError(name)
        key = SLICE_KEYS.get(name, "_id")
        df = self[name] = self._spark.read.jdbc(
            self._url, self._table_names.get(name, name),
            predicates=slice_predicates(key, self._slices, self._bucket),
            properties=self._props)
        return df


def read_jdbc_tables(spark: SparkSession, url: str, properties: Mapping[str, str],
                     slices: int = 64, table_names: Mapping[str, str] | None = None,
                     bucket: str = POSTGRES_BUCKET,
                     names: Iterable[str] | None = None) -> JdbcTables:
    """Input tables from ``url``; ``table_names`` maps report names to the
    database's own table names where they differ."""
    return JdbcTables(spark, url, properties, slices, table_names or {}, bucket, names)
