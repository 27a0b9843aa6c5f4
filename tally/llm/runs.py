"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words of one text in which words one period
apart are equal, that no neighbour extends, of at least ``min_length`` words
and ``min_periods`` periods; its period is the smallest one.

The dictionary names the factors (stretches of words) of lengths 1, 2, 4, ...:
a factor's name is the rank of the pair of its halves' names among those of
the texts of a block. Per length l every factor is linked to its successor, the
next factor of the same name. Successors that overlap it or follow at once, that
is, both lie within a window of 2l words, form arithmetic progressions whose
difference is a period: neighbouring factors with successors at one distance p
are together a stretch with period p, which reaches from the first one to the
end of the last one's successor, and no shorter period, as its factors would
recur sooner. Stretches of all lengths are deduplicated. A run of four periods
or more shows at the length between its period and twice that.

Only a factor that occurs again in its text can be half of one of twice the
length that does, so of usual texts few words stay in the dictionary after the
first lengths; the work is at most that of sorting a text's words once per
length.

Null and empty texts have no words and no runs. Rows are independent: repeats
need no rule. Extra columns are ignored; an empty table gives no rows. A single
text is held by one task, in arrays of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, schema_of
from tally.llm.textbytes import EXACT, SPACE, blocks, joined, mix, ragged

MIN_LENGTH, MIN_PERIODS = 6, 4
_FAR = np.int64(1 << 60)


def _successors(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, distance to the next and to the last place of the same key) for ascending places."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.append(False, ~same)) if len(key) else 0
    left, right = order[:-1][same], order[1:][same]
    after, before = np.full(len(key), _FAR), np.full(len(key), _FAR)
    after[left] = before[right] = place[right] - place[left]
    return rank, after, before


def find_runs(names: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, period) of the runs, by first word and period; text k has the words at[k]..at[k+1]."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    key, place, length = mix(names ^ mix(text.astype(np.uint64))), np.arange(len(names)), 1
    found = []
    while len(place):
        rank, after, before = _successors(key, place)
        # neighbours with successors at one distance, at most the factors' length
        near = np.flatnonzero(after <= length)
        gap, where = after[near], place[near]
        first = np.flatnonzero(np.append(True, (where[1:] != where[:-1] + 1) | (gap[1:] != gap[:-1]))) if len(near) else near
        last = np.append(first[1:] - 1, len(near) - 1) if len(near) else near
        size = where[last] - where[first] + length + gap[first]
        whole = (size >= min_length) & (size >= min_periods * gap[first])
        found.append(np.stack([where[first], size, gap[first]])[:, whole])
        # halves of the factors of twice the length: those that occur again
        half = np.flatnonzero(np.minimum(after, before) < _FAR)
        place, rank = place[half], rank[half]
        other = np.searchsorted(place, place + length)
        other[other == len(place)] = 0
        pair = (place[other] == place + length) & (place + 2 * length <= at[1:][text[place]])
        key = rank[pair] * np.int64(len(names) + 1) + rank[other[pair]]
        place, length = place[pair], 2 * length
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    runs = np.unique(runs[[0, 2, 1]], axis=1)       # by first word, then period
    return runs[0], runs[2], runs[1]


def _scan(keep: int, min_length: int, min_periods: int) -> Callable:
    """The kept columns, runs and collapsed text of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(keep)):
                start, end, names, at = block.words(~SPACE, EXACT)
                first, length, period = find_runs(names, at, min_length, min_periods)
                gone = np.zeros(len(start), bool)
                gone[ragged(first + period, length - period)] = True
                left = np.flatnonzero(~gone)
                text = np.searchsorted(at, first, "right") - 1
                fields = [pa.array(x) for x in (first - at[text], length, period)]
                rows = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                ends = pa.array(np.searchsorted(text, np.arange(len(block) + 1)).astype(np.int32))
                out = joined(block.data, start[left], end[left], np.searchsorted(left, at))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(block.first, len(block)) for c in batch.columns[:keep]),
                     pa.ListArray.from_arrays(ends, rows), out], [*batch.schema.names[:keep], "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None,
                  min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Columns ``keep`` (default doc_id), runs: array of struct(start, length, period) by start, then period,
    counted in words from 0, and collapsed: the words that no run holds after its first period, joined by one space.

    ``min_periods`` below four is refused: such runs need not show at any length.
    """
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods are not all found")
    prepare(docs.sparkSession)
    names = keep or ["doc_id"]
    sent = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("_text"))
    return sent.mapInArrow(_scan(len(names), min_length, min_periods), schema_of(
        sent.schema.fields[:-1], "runs array<struct<start:long,length:long,period:long>>, collapsed string"))
