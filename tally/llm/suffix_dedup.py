"""Repeated passages: content-defined anchors, grouped by hashes in three rounds.

Wanted is every byte that lies in a string of ``length`` bytes which also
starts anywhere else. Plain prefix doubling ranks every byte position in
every round, many times the text in shuffled rows. Here the rounds rank runs
of neighbouring positions, each finer than the one before, and only where the
one before could not decide.

Of the ``length - SEED_BYTES + 1`` seeds in a window of ``length`` bytes the one
with the smallest name (the leftmost of equal ones) is the window's anchor, so
that equal windows have equal anchors at equal distances, and the windows of
an anchor are one run of starts. In every round a run has a pair of ranks: the
rank of its core, the bytes common to all its windows, and that of its whole
extent at a growing offset around it. Spark sorts the pairs:

* a unique core: none of the run's windows repeats;
* a shared pair: all of them repeat;
* a core shared by different wholes: one member of each pair goes on, cut
  into shorter runs on a grid of distances to the anchor.

Round 1 has the anchors' runs (the core is the seed), round 2 runs of
``CELL`` windows, and round 3 single windows, with which the threshold is
passed: the pair is that of the names of its first half and of the one at the
offset of half the threshold.

Names are 64-bit polynomials of the bytes; only pairs of them decide. No text
is compared in the driver or gathered in one task. A text's intervals are
merged before its bytes are hashed.

Null and empty texts have no bytes and are kept as they are. Rows repeat each
other like any texts, equal rows and equal ids included: their passages are
removed from all of them. A row is known by its id and the name of its text.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, saved, schema_of
from tally.llm.textbytes import EXACT, Block, blocks, mix
from tally.operators.keyfilter import cannot_match, key_filter, may_match

SEED_BYTES = 192
CELL = 16
BROADCAST_RUNS = 400_000        # runs (about 40 bytes each) that are broadcast to the texts; more are joined by shuffle
_U = np.uint64


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys."""
    n = len(key) - width + 1
    pad = -len(key) % width
    grid = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def _anchors_of(block: Block, sums: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, anchor) of each run of windows with one anchor."""
    size = len(block.data)
    if size < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at = np.arange(size - SEED_BYTES + 1)
    seed = mix(block.names(sums, at, at + SEED_BYTES))
    # the position in the low bits breaks ties to the left
    key = (seed >> _U(32) << _U(32)) | at.astype(np.uint64)
    least = (_sliding_least(key, length - SEED_BYTES + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(least))
    text = np.searchsorted(block.offsets, start, "right") - 1
    inside = start + length <= block.offsets[text + 1]
    run = inside.copy()
    run[1:] &= ~(inside[:-1] & (least[1:] == least[:-1]) & (text[1:] == text[:-1]))
    first = np.flatnonzero(run)
    number = np.add.reduceat(inside.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return text[first], first, number, least[first]


_RUN = "at long, number int, anchor long"


def _anchors(length: int) -> Callable:
    """(id, name, at, number, anchor, core, whole): every anchor's run of windows and its ranks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                sums = block.sums(EXACT)
                text, first, number, anchor = _anchors_of(block, sums, length)
                core = mix(block.names(sums, anchor, anchor + SEED_BYTES))
                whole = _whole(block.names(sums, first, first + number - 1 + length), anchor - first, number)
                row, base = pa.array(block.first + text), block.offsets[text]
                yield _run_rows([batch.column(0).take(row), batch.column(1).take(row)], first - base, number,
                                anchor - base, core, whole)
    return run


def _whole(names: np.ndarray, distance: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The place and length of the run among the bytes are part of the rank."""
    return mix(names + mix((distance << 20 | number).astype(np.uint64)))


def _run_rows(keys: list, at, number, anchor, core, whole) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array(at), pa.array(number.astype(np.int32)), pa.array(anchor), pa.array(core.view(np.int64)),
         pa.array(whole.view(np.int64))], ["id", "name", "at", "number", "anchor", "core", "whole"])


def _finer(length: int, width: int) -> Callable:
    """Rows like the anchors' for the wanted runs of a text, cut into runs of at most ``width`` windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3).to_pylist()
            for block in blocks(batch.column(2)):
                sums = block.sums(EXACT)
                for k in range(len(block)):
                    own = wanted[block.first + k]
                    base = block.offsets[k]
                    at, number, anchor = (np.array([r[c] for r in own], np.int64) for c in ("at", "number", "anchor"))
                    # cells of the grid that the run's distances anchor - at - number + 1 .. anchor - at meet
                    low, high = (anchor - at - number + 1) // width, (anchor - at) // width
                    cells = high - low + 1
                    row = np.repeat(np.arange(len(own)), cells)
                    cell = np.repeat(low, cells) + np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
                    at, number, anchor = at[row], number[row], anchor[row]
                    first = np.maximum(at, anchor - (cell + 1) * width + 1)
                    number = np.minimum(at + number - 1, anchor - cell * width) - first + 1
                    if width > 1:
                        start = base + anchor - cell * width
                        core = block.names(sums, start, start + length - width + 1)
                        whole = block.names(sums, base + first, base + first + number - 1 + length)
                    else:
                        half = base + first + length // 2
                        core, whole = block.names(sums, base + first, half), block.names(sums, half, base + first + length)
                    core = mix(core + mix(cell.astype(np.uint64)))
                    whole = _whole(whole, anchor - first, number)
                    n = len(first)
                    yield _run_rows([pa.array([batch.column(0)[block.first + k].as_py()] * n, batch.schema.field(0).type),
                                     pa.array([batch.column(1)[block.first + k].as_py()] * n, pa.int64())],
                                    first, number, anchor, core, whole)
    return run


def merge_runs(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals [lo, hi) as maximal runs."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    cut = np.flatnonzero(lo[1:] > reach[:-1]) + 1
    first = np.concatenate([[0], cut])
    return lo[first], reach[np.concatenate([cut - 1, [len(lo) - 1]])]


def _merged(length: int) -> Callable:
    """(id, name, cuts): the removed byte intervals of a text from its runs of repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for batch in batches:
            cuts = []
            for runs in batch.column(2).to_pylist():
                at, number = (np.array([r[c] for r in runs], np.int64) for c in ("at", "number"))
                cuts.append([{"lo": x, "hi": y} for x, y in zip(*(z.tolist() for z in merge_runs(at, at + number - 1 + length)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cuts, cut)], ["id", "name", "cuts"])
    return run


def _removed(with_text: bool) -> Callable:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) from a text and its removed intervals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, digest, kept_texts = [], [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                size.append(len(data))
                if not runs:
                    gone.append(0)
                    spans.append(0)
                    kept = data
                else:
                    lo, hi = (np.array([r[c] for r in runs]) for c in ("lo", "hi"))
                    gone.append(int((hi - lo).sum()))
                    spans.append(len(lo))
                    ends = [0, *hi.tolist()]
                    kept = b"".join(data[a:b] for a, b in zip(ends, [*lo.tolist(), len(data)]))
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            out = [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                   pa.array(digest, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:       # a character cut in two at a removed run's end is dropped
                out.append(pa.array([x.decode("utf-8", "ignore") for x in kept_texts], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(out, names)
    return run


def _joined(texts: DataFrame, lists: DataFrame, entries: str, how: str) -> DataFrame:
    """``texts`` with the lists of their runs.

    A list table of few runs is broadcast; of more, only the texts whose name
    may be among the lists' are shuffled.
    """
    side = lists.withColumnsRenamed({"id": "of_id", "name": "of_name"})
    on = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("name") == F.col("of_name"))
    if (lists.agg(F.sum(F.size(entries))).first()[0] or 0) <= BROADCAST_RUNS:
        return texts.join(F.broadcast(side), on, how)
    names = key_filter(lists, "name")
    found = may_match(texts, "name", names).join(side, on, how)
    return found if how == "inner" else found.unionByName(cannot_match(texts, "name", names), allowMissingColumns=True)


def _decided(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Runs (id, name, at, number) that repeat, and a member (id, name, at, number, anchor) of each pair left open.

    Only rows that may repeat are shuffled to their pairs again. A filter alone
    picks the open pairs: a unique core that it lets through has no window
    that repeats, in the next round either.
    """
    classes = saved(rows.groupBy("core", "whole").agg(
        F.count("*").alias("members"), F.min(F.struct("id", "name", "at", "number", "anchor")).alias("first")), name)
    same = classes.where("members > 1").select("core", "whole")
    repeated = may_match(rows, "whole", key_filter(same, "whole")).join(same, ["core", "whole"], "left_semi")
    several = classes.groupBy("core").agg(F.count("*").alias("wholes")).where("wholes > 1")
    open_ = may_match(classes, "core", key_filter(several, "core"))
    return repeated.select("id", "name", "at", "number"), open_.select("first.*")


def repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """(id, name, at, number): runs of starts of repeated windows; ``texts`` has id, name and text."""
    fields = [f for f in texts.schema.fields if f.name in ("id", "name")]
    schema = schema_of(fields, f"{_RUN}, core long, whole long")
    anchors = saved(texts.where(F.octet_length("text") >= length).mapInArrow(_anchors(length), schema), "anchors")
    # a unique seed that the filter lets through is a pair of one member with a unique core
    twice = anchors.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    rows = saved(may_match(anchors, "core", key_filter(twice, "core")), "runs")
    repeated, open_ = _decided(rows, "runs-classes")
    for width in (CELL, 1):
        wanted = saved(open_.groupBy("id", "name").agg(F.collect_list(F.struct("at", "number", "anchor")).alias("runs")),
                       "runs-open")
        rows = saved(_joined(texts, wanted, "runs", "inner").select("id", "name", "text", "runs")
                     .mapInArrow(_finer(length, width), schema), "runs")
        more, open_ = _decided(rows, "runs-classes")     # nothing is open after single windows
        repeated = repeated.unionByName(more)
    return repeated


def remove_repeats(docs: DataFrame, *, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row, with ``kept_text`` if wanted."""
    if length <= SEED_BYTES:
        raise ValueError(f"length has to be over {SEED_BYTES} bytes")
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("name"), text.alias("text"))
    lists = repeated_runs(texts, length).groupBy("id", "name").agg(F.collect_set(F.struct("at", "number")).alias("runs"))
    cuts = saved(lists.mapInArrow(_merged(length), schema_of(lists.schema.fields[:2], "cuts array<struct<lo:long,hi:long>>")),
                 "cuts")
    extra = ", kept_text string" if with_text else ""
    out = _joined(texts, cuts, "cuts", "left").select("id", "text", "cuts").mapInArrow(_removed(with_text), schema_of(
        texts.schema.fields[:1], f"n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}"))
    return out.withColumnRenamed("id", id_col)
