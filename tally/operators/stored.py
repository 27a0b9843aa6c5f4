"""Tables stored by key, so that work per key needs no shuffle.

``write_by_key`` writes a bucketed, sorted table: all rows of a key lie in one
bucket file set, and Spark plans windows, aggregates and joins by that key on
its scan without an exchange. A bucket is read by one task, so a key with a
third of all rows would be one long task: keys with more rows than an even
bucket holds (fewer than there are buckets) are stored apart in a plain table,
where the shuffling plan with its partial aggregates applies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT = "_hot"


def write_by_key(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Store ``df`` as table ``name``, and the rows of its hot keys as ``name`` + ``_hot``.

    One pass counts the rows per key, one writes them. A NULL key is a key.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("__tally_n"))
    total = df.count()
    hot = counts.where(F.col("__tally_n") * buckets > total).select(F.col(key).alias("__tally_key"))
    same = F.col(key).eqNullSafe(F.col("__tally_key"))
    hot = F.broadcast(hot)              # fewer rows than buckets
    (df.join(hot, same, "left_anti").repartition(buckets, key)
       .write.bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    df.join(hot, same, "left_semi").write.saveAsTable(name + HOT)


def stored_tables(spark: SparkSession, name: str, stored: str) -> dict[str, DataFrame]:
    """Table ``name`` of the reports and its hot part, read from the stored table."""
    return {name: spark.table(stored), name + HOT: spark.table(stored + HOT)}


def by_part(name: str) -> Callable:
    """A step that works per key of table ``name``, done for each of its parts where it is stored in two.

    The step may read no other table.
    """
    def decorate(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(step)
        def run(t: Mapping[str, DataFrame], *args, **kwargs) -> DataFrame:
            if name + HOT not in t:
                return step(t, *args, **kwargs)
            parts = [step({name: t[part]}, *args, **kwargs) for part in (name, name + HOT)]
            return parts[0].unionByName(parts[1])
        return run
    return decorate
