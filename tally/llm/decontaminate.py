"""Benchmark decontamination: prefix-filtered set join of documents and item windows.

A window is ``size`` consecutive words of an item (a shorter item is one
window of all its words). A window is seen as the set of its word shingles;
to contain it, a document must hold every one of them, so a prefix of one
shingle is necessary, and the rarest in the corpus makes the fewest
candidates. The rarity is counted over all documents; a window with a shingle
that never occurs is dropped. A document's shingles are joined with the
prefixes; each match fixes the only place where the window can lie
(positional bound), which must hold as many words of the document (length
bound); the words there are compared with the window's, byte for byte.

The shingles of all windows are counted in one pass over the documents. The
windows are the broadcast side: in parts of at most ``PART`` windows, as many as
needed, of which a task holds one at a time and loads each once a batch.

Null and empty texts have no words and contain nothing; items without words
have no windows. Repeated documents are rows of their own, repeated items
count once per id; null item ids are left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, saved, schema_of
from tally.llm.textbytes import LOWER, WORDY, Block, blocks, mix

SHINGLE = 3
PART = 500_000          # windows broadcast at once (about 200 bytes each)
_BASE = np.uint64(0x9E6C63D0876A9A35)


def _sequence(names: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Names of the ``width``-word sequences that begin at the words ``start``."""
    total = np.full(len(start), width, np.uint64)
    for k in range(width):
        total = total * _BASE + names[start + k]
    return mix(total)


def _starts(at: np.ndarray, width: int) -> np.ndarray:
    """Words at which a sequence of ``width`` words of one text begins."""
    lengths = np.maximum(np.diff(at) - width + 1, 0)
    first = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return first + np.arange(lengths.sum())


def _windows(size: int) -> Callable:
    """(item, words, sequence, shingles): each window once per item of the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, words, sequences, parts = [], [], [], []
            for block in blocks(batch.column(1)):
                start, end, names, at = block.words(WORDY, LOWER)
                text = block.data.tobytes().lower()
                for k in range(len(block)):
                    n = int(at[k + 1] - at[k])
                    width = min(n, size)
                    for i in range(at[k], at[k + 1] - width + 1 if n else at[k]):
                        items.append(batch.column(0)[block.first + k].as_py())
                        words.append(b" ".join(text[start[j]:end[j]] for j in range(i, i + width)))
                        s = min(SHINGLE, width)
                        own = _sequence(names, np.arange(i, i + width - s + 1), s)
                        parts.append(own.view(np.int64).tolist())
                        sequences.append(int(_sequence(names, np.array([i]), width).view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(words, pa.binary()), pa.array(sequences, pa.int64()),
                 pa.array(parts, pa.list_(pa.int64()))], ["item", "words", "sequence", "shingles"])
    return run


def _rarity(late, widths: list[int]) -> Callable:
    """Occurrences of the windows' shingles in a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = late.value
        if not len(vocabulary):
            return
        totals = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, _, names, at = block.words(WORDY, LOWER)
                for width in widths:
                    found = _sequence(names, _starts(at, width), width)
                    where = np.searchsorted(vocabulary, found)
                    where[where == len(vocabulary)] = 0
                    totals += np.bincount(where[vocabulary[where] == found], minlength=len(vocabulary))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary[seen].view(np.int64)), pa.array(totals[seen])],
                                         ["shingle", "n"])
    return run


class _Index:
    """One part of the windows by their prefix shingle."""

    def __init__(self, rows: list, vocabulary: np.ndarray, counts: np.ndarray):
        by: dict[bytes, tuple[int, list[int], set]] = {}
        for r in rows:
            by.setdefault(bytes(r["words"]), (r["sequence"], r["shingles"], set()))[2].add(r["item"])
        occurs = lambda s: counts[np.searchsorted(vocabulary, np.array(s, np.int64).view(np.uint64))]
        live = [(w, q, s, i, n) for w, (q, s, i) in by.items() if (n := occurs(s)).all()]
        self.words = [w for w, *_ in live]
        self.items = [sorted(i) for _, _, _, i, _ in live]
        self.length = np.array([w.count(b" ") + 1 for w in self.words], np.int64)
        self.sequence = np.array([q for _, q, *_ in live], np.int64).view(np.uint64)
        offset = [min(range(len(s)), key=lambda k: (n[k], s[k])) for _, _, s, _, n in live]
        prefix = np.array([s[k] for (_, _, s, _, _), k in zip(live, offset)], np.int64).view(np.uint64)
        order = np.argsort(prefix, kind="stable")
        self.window, self.offset = order, np.array(offset, np.int64)[order] if live else order
        self.prefix, self.first = np.unique(prefix[order], return_index=True)
        self.first = np.append(self.first, len(order))

    def places(self, block: Block, start, end, names, at, widths) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (first word, window) in the texts of a block."""
        hits, kinds = [], []
        if not len(self.prefix):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lower = None
        for width in widths:
            begin = _starts(at, width)
            found = _sequence(names, begin, width)
            where = np.searchsorted(self.prefix, found)
            where[where == len(self.prefix)] = 0
            match = np.flatnonzero(self.prefix[where] == found)
            token, word = where[match], begin[match]
            count = self.first[token + 1] - self.first[token]
            row = np.repeat(self.first[token] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) \
                + np.arange(count.sum())
            word = np.repeat(word, count)
            window, place = self.window[row], word - self.offset[row]
            text = np.searchsorted(at, word, "right") - 1
            ok = (np.minimum(self.length[window], SHINGLE) == width) & (place >= at[text]) \
                & (place + self.length[window] <= at[text + 1])
            window, place = window[ok], place[ok]
            for length in np.unique(self.length[window]):
                own = np.flatnonzero(self.length[window] == length)
                same = own[_sequence(names, place[own], int(length)) == self.sequence[window[own]]]
                for i in same:
                    if lower is None:
                        lower = block.data.tobytes().lower()
                    words = range(place[i], place[i] + length)
                    if b" ".join(lower[start[j]:end[j]] for j in words) == self.words[window[i]]:
                        hits.append(place[i])
                        kinds.append(window[i])
        return np.array(hits, np.int64), np.array(kinds, np.int64)


def _match(late: list, widths: list[int], keep: int) -> Callable:
    """The kept columns and n_words, n_hit, items of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            items: list[set] = [set() for _ in range(batch.num_rows)]
            cut = [(block, block.words(WORDY, LOWER)) for block in blocks(batch.column(keep))]
            change = [np.zeros(len(words[0]) + 1, np.int64) for _, words in cut]
            for part in late:
                index = part.value
                for (block, (start, end, names, at)), own in zip(cut, change):
                    place, window = index.places(block, start, end, names, at, widths)
                    np.add.at(own, place, 1)
                    np.add.at(own, place + index.length[window] if len(place) else place, -1)
                    for text, kind in zip(np.searchsorted(at, place, "right") - 1, window):
                        items[block.first + text].update(index.items[kind])
                if len(late) > 1:           # one part in memory at a time
                    del index, part._value
            for (block, (_, _, _, at)), own in zip(cut, change):
                rows = slice(block.first, block.first + len(block))
                n_words[rows] = np.diff(at)
                hit = np.concatenate([[0], np.cumsum(np.cumsum(own[:-1]) > 0)])
                n_hit[rows] = hit[at[1:]] - hit[at[:-1]]
            names_out = [*batch.schema.names[:keep], "n_words", "n_hit", "items"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(n_words), pa.array(n_hit),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names_out)
    return run


def benchmark_hits(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", size: int = 10, keep: list[str] | None = None,
                   part: int = PART) -> DataFrame:
    """Columns ``keep`` (default doc_id) plus n_words, n_hit (words inside an occurrence of a
    window) and items (ids of items with occurring windows, sorted as strings)."""
    spark = prepare(docs.sparkSession)
    kept = keep or ["doc_id"]
    windows = saved(items.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
        .mapInArrow(_windows(size), "item string, words binary, sequence long, shingles array<long>"), "windows")
    text = F.col(text_col).cast("string")
    widths = sorted(r[0] for r in windows.select(F.least(
        F.lit(SHINGLE), F.size(F.split(F.col("words").cast("string"), " ")))).distinct().collect())
    found = windows.select(F.explode("shingles").alias("shingle")).distinct().toPandas()     # 8 bytes a word of the items
    names = np.sort(found["shingle"].to_numpy(np.int64).view(np.uint64))
    vocabulary = spark.sparkContext.broadcast(names)
    counted = docs.select(text.alias("text")).mapInArrow(
        _rarity(vocabulary, widths), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(names), np.int64)
    counts[np.searchsorted(names, counted["shingle"].to_numpy(np.int64).view(np.uint64))] = counted["n"].to_numpy(np.int64)
    parts = -(-windows.count() // part)
    late = []
    for p in range(parts):
        rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == p).collect()
        late.append(spark.sparkContext.broadcast(_Index(rows, names, counts)))
    sent = docs.select(*[F.col(c) for c in kept], text.alias("_text"))
    return sent.mapInArrow(_match(late, widths, len(kept)),
                           schema_of(sent.schema.fields[:-1], "n_words long, n_hit long, items array<string>"))


def items_digest(items):
    """Lowercase hex SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
