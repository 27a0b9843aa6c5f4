"""Connected components of a table of links, without collecting any of them.

Alternating star contraction: every round points each node's larger
neighbours, then its smaller ones, at the smallest neighbour. Rounds are
logarithmic in practice and each is a few shuffles of the (shrinking) links,
kept as a written table. A node with very many links is a hot key of the
join, which adaptive execution splits; the minimum is pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links (u > v) by the smallest neighbour of each node."""
    if large:       # all neighbours of a node, those above it are re-pointed
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:           # the smaller neighbours only
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    near = both.join(least, "u")
    if large:
        out = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _digest(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str, b: str, name: str = "links") -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest node.

    ``a`` and ``b`` are columns of one orderable type. Self-links, nulls and
    repeated links are ignored; no links give no rows.
    """
    now = saved(links.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name)
    was = _digest(now)
    while was[0]:
        now = saved(_star(_star(now, True), False), name)
        then = _digest(now)
        if then == was:
            break
        was = then
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node")))
