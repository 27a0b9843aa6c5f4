"""Materialise a relation that several branches of one plan read.

Spark recomputes a shared sub-plan once per branch (with different filters
pushed into each copy, exchanges are not reused). For a large join read by
several branches, writing it once to the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) is cheaper than recomputing and re-shuffling it,
and it cuts the lineage: a lost executor re-reads the checkpoint files
instead of recomputing the join. Never a machine-local folder, never
``localCheckpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tally.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint of ``df`` in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
