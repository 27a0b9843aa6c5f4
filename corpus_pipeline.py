"""A training-corpus pipeline of five of the operators, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; ``run`` writes each stage's rows as Parquet into the shared
folder and rereads them. All stages but the last return the columns of
``documents``; these travel as one struct, so that no column name of theirs
can clash with an operator's.

The stages learn from the labelled table and the documents at hand only, so
empty tables, nulls, ties and repeated rows have the results that the
operators define for them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.decontaminate import benchmark_hits
from tally.llm.importance import resample
from tally.llm.jaccard_join import BROADCAST_IDS, jaccard_components
from tally.llm.mixing import mix
from tally.llm.pii import find_pii, masked
from tally.llm.queries import DOMAIN_WEIGHTS, labelled_domains, table
from tally.llm.store import prepare, saved, sized


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards documents of good quality; the others go."""
    rows = resample(_packed(docs), table(spark, sf_dir, "labels"), keep=["_row", "doc_id"])
    return rows.where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Jaccard components of five-word shingles at 0.8; of each one row stays, that of the smallest id.

    A row is known by its id and two hashes of its text, so an id of several texts is several rows. Null ids come
    last. Of the rows of one id and text, which are copies, one stays; texts without words are linked with nothing
    and all stay.
    """
    prepare(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"),
                   *[F.xxhash64(F.lit(k), text).alias(f"h{k}") for k in (1, 2)])
    parts = ("unknown", "id", "h1", "h2")
    rows = saved(jaccard_components(docs.select(key.alias("doc_id"), "text"), size=5, percent=80).where("n_shingles > 0"),
                 "near-duplicates")

    def listed(some: DataFrame) -> DataFrame:
        """The keys as columns, to be joined with the rows of ``docs``."""
        own = saved(some.select(*[F.col("doc_id")[c].alias(f"_{c}") for c in parts]), "near-keys")
        return sized(own, BROADCAST_IDS)

    keyed = docs.withColumn("_key", key)
    gone = listed(rows.where("doc_id <> component_id").select("doc_id").distinct())
    again = listed(rows.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"))
    on = lambda keys: reduce(lambda a, b: a & b, [keyed["_key"][c].eqNullSafe(keys[f"_{c}"]) for c in parts])
    left = keyed.join(gone, on(gone), "left_anti")
    many = left.join(again, on(again), "left_semi").dropDuplicates(["_key"])
    return left.join(again, on(again), "left_anti").unionByName(many).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    hits = benchmark_hits(_packed(docs), table(spark, sf_dir, "benchmark"), size=10, keep=["_row"])
    return hits.where("n_hit = 0").select("_row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; ``n_chars`` follows the text."""
    rows = find_pii(_packed(docs), keep=["_row"])
    rows = rows.withColumn("_text", masked(F.col("_row.text"), F.concat("base", "added"))).select("_row.*", "_text")
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_text") == F.col("text"), F.col("n_chars")).otherwise(
            F.length("_text")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the expected domain tokens to DOMAIN_WEIGHTS."""
    rows = mix(docs.select("doc_id", "text"), labelled_domains(table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS)
    return rows.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(DOMAIN_WEIGHTS)],
                       "rate")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mixing),
]

#: SQL can't state the models' stages; tests/llm holds each stage against plain Python or what it has to reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
