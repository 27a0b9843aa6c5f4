"""Table sources: schemas of the report inputs, parquet readers, derived test views."""

from tally.sources.fixtures import fixture_tables
from tally.sources.jdbc import read_jdbc_tables
from tally.sources.tables import SCHEMAS, read_tables

__all__ = ["SCHEMAS", "fixture_tables", "read_jdbc_tables", "read_tables"]
