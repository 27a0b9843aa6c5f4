"""Mixing documents to target domain weights by soft membership.

A naive Bayes classifier over hashed unigrams, fitted on a bounded sample of a
labelled table, gives every document a posterior p over domains (the
likelihood is tempered to that of ``EVIDENCE`` tokens, as longer texts do not
make memberships certain). Document rates r >= 0 are fitted such that the
expected domain token totals, sum of r * tokens * p, match the targets:

    minimise  |A r - T|^2 / (2 S^2)  +  ridge / (2 S) * sum(tokens * (r - 1)^2)

with S all tokens, A the expected domain tokens, T = S * weights. The ridge only
picks, of all rates that meet the targets, those nearest to one; it is so small
that it leaves no gap to speak of. At the minimum every rate is the projection
max(0, 1 - p . g) of a step against one gradient g in domain space, so g is all
that the passes need to share. Each pass over the written posteriors projects
the rates of several trial steps and returns, per trial, as many sums as there
are domains, and their products over the documents above zero, in whose metric
the next step is taken. The longest trial that lowers the (convex) objective is
kept; the fit ends when the gradient is within ``TOLERANCE``, or when no trial
lowers it, at the precision of doubles. It takes few passes and no step cap.

Null and empty texts have no tokens, the prior as posterior and a rate like
others, which adds nothing. Rows are independent of one another but for the
sums: repeats and ties need no rule. Targets are scaled to sum to one; domains
without labelled rows can't be met and get no mass. Labelled rows with a null
id or domain are left out. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.ngrams import collect_counts, count_rows, features, labelled_sample
from tally.llm.store import prepare, saved, schema_of
from tally.llm.textbytes import blocks

BUCKETS = 1 << 14
LABELLED_BOUND = 50_000     # labelled rows that the classifier is fitted on, at most
EVIDENCE = 64.0
RIDGE = 1e-7
TOLERANCE = 1e-7            # of the totals' shares
TRIALS = tuple(4.0 ** -k for k in range(14))    # lengths of a pass's steps


def _counts(classes: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((classes, buckets), np.int64)
        for batch in batches:
            cls = batch.column(1).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(0)):
                bucket, owner, *_ = features(block, buckets, bigrams=False)
                flat = cls[block.first + owner] * buckets + bucket
                totals += np.bincount(flat, minlength=classes * buckets).reshape(classes, buckets)
        yield from count_rows(totals)
    return run


def _posteriors(classes: int, buckets: int, late, keep: int) -> Callable:
    """The kept columns, n_tokens and posterior."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, likelihood = late.value
        for batch in batches:
            score, tokens = np.zeros((batch.num_rows, classes)), np.zeros(batch.num_rows, np.int64)
            for block in blocks(batch.column(keep)):
                bucket, owner, n, *_ = features(block, buckets, bigrams=False)
                own = slice(block.first, block.first + len(block))
                tokens[own] = n
                for c in range(classes):
                    score[own, c] = np.bincount(owner, likelihood[c][bucket], len(block))
            score *= (np.minimum(tokens, EVIDENCE) / np.maximum(tokens, 1))[:, None]
            score += prior
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            ends = np.arange(0, p.size + 1, classes, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(tokens), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))],
                [*batch.schema.names[:keep], "n_tokens", "posterior"])
    return run


def _matrix(column: pa.Array, classes: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)


def _totals(classes: int, points: np.ndarray) -> Callable:
    """Per trial point g: domain tokens at the rates, their products by p, and half the squared rates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(points), classes + classes * classes + 1))
        for batch in batches:
            p, tokens = _matrix(batch.column(1), classes), batch.column(0).to_numpy(zero_copy_only=False)
            products = (p[:, :, None] * p[:, None, :]).reshape(len(p), -1)
            for row, g in zip(sums, points):
                rate = np.maximum(0.0, 1.0 - p @ g)
                row[:classes] += (rate * tokens) @ p
                row[classes:-1] += ((rate > 0) * tokens) @ products
                row[-1] += (rate * rate * tokens).sum() / 2.0
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(points)), pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["row", "sums"])
    return run


def _rates(classes: int, g: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column(batch.schema.get_field_index("posterior")), classes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.maximum(0.0, 1.0 - p @ g))],
                                             [*batch.schema.names, "rate"])
    return run


def fit_gradient(rows: DataFrame, weights: np.ndarray, *, ridge: float = RIDGE, tolerance: float = TOLERANCE) -> np.ndarray:
    """g of the rates max(0, 1 - p . g), for a written table with n_tokens and posterior."""
    classes, small = len(weights), rows.select("n_tokens", "posterior")
    g = np.zeros(classes)
    total = float(small.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return g

    def measured(points: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(objective, gradient, curvature) at each point."""
        got = small.mapInArrow(_totals(classes, points), "row int, sums array<double>")
        each = [F.sum(F.col("sums")[c]).alias(str(c)) for c in range(classes + classes * classes + 1)]
        out = {}
        for r in got.groupBy("row").agg(*each).collect():       # as many rows as trials
            x = np.array(r[1:]) / total
            own = points[r["row"]]
            out[r["row"]] = (x[-1] + weights @ own + ridge * own @ own / 2.0, weights - x[:classes] + ridge * own,
                             x[classes:-1].reshape(classes, classes) + ridge * np.eye(classes))
        return [out[k] for k in range(len(points))]

    value, slope, curve = measured(g[None])[0]
    while np.abs(slope).max() > tolerance:
        step = np.linalg.solve(curve, -slope)
        points = g + np.outer(TRIALS, step)
        lower = [(point, *now) for point, now in zip(points, measured(points)) if now[0] < value]
        if not lower:
            break
        g, value, slope, curve = min(lower, key=lambda x: x[1])
    return g


def domain_posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], *, id_col: str = "doc_id",
                      text_col: str = "text", domain_col: str = "domain", keep: list[str] | None = None,
                      buckets: int = BUCKETS, bound: int = LABELLED_BOUND) -> DataFrame:
    """Columns ``keep`` (default: the id) plus n_tokens and posterior, in the order of ``domains``."""
    spark = prepare(docs.sparkSession)
    index = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col(domain_col)) - 1
    sample = saved(labelled_sample(labelled.where(F.col(domain_col).isin(domains)).select(
        F.col(id_col).alias("_label_id"), index.cast("int").alias("_cls")), "_label_id", bound), "labelled")
    text = F.col(text_col).cast("string")
    marked = docs.join(F.broadcast(sample), F.col(id_col) == F.col("_label_id")).select(text.alias("text"), "_cls")
    counts = collect_counts(marked.mapInArrow(_counts(len(domains), buckets), "cls int, bucket int, n long"),
                            len(domains), buckets)
    have = {r["_cls"]: r["count"] for r in sample.groupBy("_cls").count().collect()}
    rows = np.array([have.get(c, 0) for c in range(len(domains))], float)
    with np.errstate(divide="ignore"):
        prior = np.log(rows / rows.sum()) if rows.sum() else np.zeros(len(domains))
    likelihood = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * buckets))
    late = spark.sparkContext.broadcast((prior, likelihood))
    names = keep or [id_col]
    sent = docs.select(*[F.col(c) for c in names], text.alias("_text"))
    return sent.mapInArrow(_posteriors(len(domains), buckets, late, len(names)),
                           schema_of(sent.schema.fields[:-1], "n_tokens long, posterior array<double>"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *, ridge: float = RIDGE,
        tolerance: float = TOLERANCE, **options) -> DataFrame:
    """Columns ``keep`` plus n_tokens, posterior (in the order of ``targets``) and rate."""
    domains = list(targets)
    weights = np.array([max(0.0, targets[d]) for d in domains])
    weights = weights / weights.sum()
    rows = saved(domain_posteriors(docs, labelled, domains, **options), "posteriors")
    g = fit_gradient(rows, weights, ridge=ridge, tolerance=tolerance)
    return rows.mapInArrow(_rates(len(domains), g), schema_of(rows.schema.fields, "rate double"))
