"""Quality classifier: importance resampling with hashed n-gram models.

Two generative models count in how many documents each hashed n-gram occurs:
the target's (documents of good quality, from a bounded sample of labelled
rows) and the raw text's (all documents). A document's log importance weight
is the sum over the n-grams it holds of log((c + s) / (e + s)): c the target
count of the bucket, e its expectation under the raw model, s a pseudo-count.
A bucket's term is shrunk by max(0, 1 - Z^2 / z^2), z being its deviation in
standard errors, so that buckets without evidence add no noise, however many
a long document has. Standard Gumbel noise, a hash of the id, turns the k
largest keys ``log_weight + noise`` into a weighted sample without replacement.

k, unless given, is the number of documents whose weight passes the cutoff
that separates the labelled ids best (an id of several rows by their mean). Ties at the k-th key are all kept.

Null and empty texts have weight 1 (log 0). Null ids share one noise value,
repeated rows one key, so they are kept or rejected together. Without target
or other rows among the labels everything is kept. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.ngrams import collect_counts, count_rows, labelled_sample, present
from tally.llm.select import kth_largest
from tally.llm.store import prepare, saved, schema_of
from tally.llm.textbytes import blocks

BUCKETS = 1 << 14
LABELLED_BOUND = 50_000     # labelled rows the target model is fitted on, at most
PSEUDO = 1.0
BURST = 2.0                 # variance of a count over its mean: documents have copies
Z = 3.0
SEED = 17


def _counts(buckets: int) -> Callable:
    """Rows (cls, bucket, n) of a task: class 0 all texts, class 1 the target's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            good = np.asarray(batch.column(1).to_pylist(), bool)
            for block in blocks(batch.column(0)):
                bucket, owner = present(block, buckets)
                totals[0] += np.bincount(bucket, minlength=buckets)
                totals[1] += np.bincount(bucket[good[block.first + owner]], minlength=buckets)
        yield from count_rows(totals)
    return run


def _weights(buckets: int, late, text_at: int) -> Callable:
    """The kept columns and log_weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = late.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for block in blocks(batch.column(text_at)):
                bucket, owner = present(block, buckets)
                out[block.first:block.first + len(block)] = np.bincount(owner, ratio[bucket], len(block))
            yield pa.RecordBatch.from_arrays([*batch.columns[:text_at], pa.array(out)],
                                             [*batch.schema.names[:text_at], "log_weight"])
    return run


def importance_weights(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "quality", buckets: int = BUCKETS, bound: int = LABELLED_BOUND,
                       keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Columns ``keep`` (default: the id) plus log_weight and key; and the labelled sample."""
    spark = prepare(docs.sparkSession)
    sample = saved(labelled_sample(labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("_label_id"), (F.col(label_col) == 1).alias("_good")), "_label_id", bound), "labelled")
    text = F.col(text_col).cast("string")
    marked = docs.join(F.broadcast(sample.where("_good")), F.col(id_col) == F.col("_label_id"), "left").select(
        text.alias("text"), F.col("_good").isNotNull().alias("good"))
    totals = collect_counts(marked.mapInArrow(_counts(buckets), "cls int, bucket int, n long"), 2, buckets)
    raw, target = totals
    expected = raw * (sample.where("_good").count() / max(1, docs.count()))
    z2 = np.maximum((target - expected) ** 2 / (BURST * (expected + 1.0)), 1e-9)
    log_ratio = np.log((target + PSEUDO) / (expected + PSEUDO)) * np.maximum(0.0, 1.0 - Z * Z / z2)
    late = spark.sparkContext.broadcast(log_ratio)
    names = keep or [id_col]
    sent = docs.select(*[F.col(c) for c in names], text.alias("_text"))
    scored = sent.mapInArrow(_weights(buckets, late, len(names)), schema_of(sent.schema.fields[:-1], "log_weight double"))
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(SEED)), 11).cast("double") + 0.5) / float(1 << 53)
    return scored.withColumn("key", F.col("log_weight") - F.log(-F.log(u))), sample


def cutoff(weights: np.ndarray, good: np.ndarray) -> float | None:
    """The middle of the gap that separates good from other labelled rows best (shares weighed alike)."""
    if not len(weights) or good.all() or not good.any():
        return None
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    gain = np.cumsum(~good) / (~good).sum() - np.cumsum(good) / good.sum()
    gain[:-1][weights[:-1] == weights[1:]] = -1.0       # no cut between equal weights
    at = int(np.argmax(gain))
    above = weights[min(at + 1, len(weights) - 1)]
    return float((weights[at] + above) / 2) if above > weights[at] else float(np.nextafter(above, np.inf))


def resample(docs: DataFrame, labels: DataFrame, *, k: int | None = None, keep: list[str] | None = None,
             id_col: str = "doc_id", **options) -> DataFrame:
    """Columns ``keep`` plus log_weight, key and kept: whether the row is among the k largest keys."""
    scored, sample = importance_weights(docs, labels, keep=keep, id_col=id_col, **options)
    scored = saved(scored, "importance")
    if k is None:
        known = scored.join(F.broadcast(sample), F.col(id_col) == F.col("_label_id")).groupBy("_label_id").agg(
            F.avg("log_weight").alias("log_weight"), F.first("_good").alias("_good"))
        known = known.toPandas()        # one row per labelled id, however often it occurs
        cut = cutoff(known["log_weight"].to_numpy(float), known["_good"].to_numpy(bool))
        if cut is None:
            return scored.withColumn("kept", F.lit(True))
        k = scored.where(F.col("log_weight") >= cut).count()
    least = kth_largest(scored, "key", k)
    return scored.withColumn("kept", F.lit(False) if least is None else F.col("key") >= F.lit(least))
