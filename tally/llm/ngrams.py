"""Hashed n-gram counts of texts, the features of the models of this subpackage.

Tokens are runs of letters, digits and non-ASCII characters (A-Z lowered) and
runs of other visible characters. Features are unigrams and bigrams, hashed
into a fixed number of buckets. A token that equals the one before it, or the
one before that, is a repeat, the same feature whatever the token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.textbytes import LOWER, SPACE, WORDY, Block, mix

_U = np.uint64
_MARKS = ~(WORDY | SPACE)
_TWO = _U(0xA24BAED4963EE407)


def features(block: Block, buckets: int, bigrams: bool = True) -> tuple[np.ndarray, ...]:
    """Bucket and text of every feature, tokens per text, and name and text of every token."""
    parts = [block.words(WORDY, LOWER), block.words(_MARKS, LOWER)]
    start = np.concatenate([p[0] for p in parts])
    order = np.argsort(start, kind="stable")
    start, names = start[order], np.concatenate([p[2] for p in parts])[order]
    at = np.searchsorted(start, block.offsets)
    text = np.repeat(np.arange(len(block)), np.diff(at))
    shift = _U(64 - (buckets - 1).bit_length())
    out, owner = [mix(names) >> shift], [text]
    if bigrams and len(names) > 1:
        same = text[1:] == text[:-1]
        out.append(mix(names[:-1][same] * _TWO + names[1:][same]) >> shift)
        owner.append(text[1:][same])
    return np.concatenate(out).astype(np.int64), np.concatenate(owner), np.diff(at), names, text


def present(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text), once each: the unigrams and bigrams that a text holds, and one feature for
    every power of a half that its share of repeats reaches.

    The last quarter of the buckets is for runs of marks and for repeats, which are few kinds and
    would drown among the words of a bucket.
    """
    wide = buckets // 4 * 3
    bucket, owner, _, names, text = features(block, buckets)
    bucket = bucket * wide // buckets
    start, _, marks, at = block.words(_MARKS, LOWER)
    mark = wide + (mix(marks) % _U(buckets - wide - 16)).astype(np.int64)
    again = np.zeros(len(names), bool)
    for back in (1, 2):
        again[back:] |= (names[back:] == names[:-back]) & (text[back:] == text[:-back])
    repeats, total = (np.bincount(x, minlength=len(block)) for x in (text[again], text))
    level = [np.flatnonzero((repeats >= 4) & (repeats << k >= total)) for k in range(1, 9)]
    bucket = np.concatenate([bucket, mark, *[np.full(len(t), buckets - 1 - k) for k, t in enumerate(level)]])
    owner = np.concatenate([owner, np.repeat(np.arange(len(block)), np.diff(at)), *level])
    pair = np.unique(owner * buckets + bucket)
    return pair % buckets, pair // buckets


def count_rows(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A (classes, buckets) count matrix as rows (cls, bucket, n), zeros left out."""
    cls, bucket = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cls, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[cls, bucket], pa.int64())],
        ["cls", "bucket", "n"])


def collect_counts(rows: DataFrame, classes: int, buckets: int) -> np.ndarray:
    """The summed counts; at most classes * buckets rows reach the driver, for any corpus."""
    table = np.zeros((classes, buckets), np.int64)
    got = rows.groupBy("cls", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table[got["cls"].to_numpy(int), got["bucket"].to_numpy(int)] = got["n"].to_numpy(np.int64)
    return table


def labelled_sample(labels: DataFrame, id_col: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows, one per id, in the order of a hash of the id."""
    kept = labels.dropDuplicates([id_col]).where(F.col(id_col).isNotNull())
    return kept.orderBy(F.xxhash64(F.col(id_col), F.lit(7)), id_col).limit(bound)
