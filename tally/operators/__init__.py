"""Relational building blocks shared by the reports."""

from tally.operators.latest import (
    first_value_per_key,
    latest_per_key,
    newest,
    oldest,
    tiebreak_columns,
)
from tally.operators.optional import optional_filters
from tally.operators.partitions import prune_months, with_month, write_by_month
from tally.operators.pivot import pivot_sums
from tally.operators.voids import void_cutoffs, without_earlier_than

__all__ = [
    "first_value_per_key", "latest_per_key", "newest", "oldest", "optional_filters",
    "pivot_sums", "prune_months", "tiebreak_columns", "void_cutoffs", "with_month", "without_earlier_than",
    "write_by_month",
]
