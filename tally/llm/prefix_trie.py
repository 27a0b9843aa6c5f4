"""Conversation prefix trie by whole-sequence collapse.

A conversation is a sequence of turns. Every distinct sequence of the first d
turns of a conversation is a node of depth d, below the node of its first
d - 1 turns; the root has no turns. The trie is never built turn by turn:

1. Every conversation becomes one row with the names of its turns. Identical
   ones collapse into one weighted sequence with its smallest id; the ids that
   end there are kept as a list, in chunks.
2. Sequences that are proper prefixes of others are found by an anti-join with
   the names of all proper prefixes; what it leaves are the leaves.
3. Prefixes of the weighted sequences are aggregated to nodes, summed before
   the shuffle, so a beginning that a third of all conversations share is a row
   per task.
4. A node belongs to the conversation with the smallest id below it, so every
   sequence has the nodes from some depth on. Sums over subtrees follow from one
   row per sequence and depth: the suffix sums of its own nodes' values, and
   above these their total, added up by node.

Turns have names of 128 bits, hashes of role and text, and a prefix the sums
of its turns' names mixed with their places, which arrays of a task's
sequences give at once. Children of a node that has more than a ten-thousandth
of all nodes as its children (so fewer than ten thousand such nodes) find it by
broadcast, the others by shuffle.

Rows without a conversation id are left out. Null roles and texts are empty.
Turns are ordered by the order column, nulls first, ties by name; repeated rows
are repeated turns. An empty table gives no nodes. Extra columns are ignored. A
conversation's names (24 bytes a turn, no texts) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, saved
from tally.llm.textbytes import mix, ragged

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 16             # ids in a chunk of an end list
HOT_SHARE = 10_000          # nodes over the children that make a parent hot, at least HOT_LEAST
HOT_LEAST = 1000
NAME = ["depth", "a", "b"]
_SEQUENCE = "array<struct<a:long,b:long,words:long>>"


def sequences(turns: DataFrame, *, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the names and word counts of every conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(order_col).alias("at"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "a", "b", "words")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["words"].alias("words"))).alias("turns"))


class _Paths:
    """The prefixes of a batch's sequences, from no turn to all, sequence by sequence."""

    def __init__(self, lists: pa.ListArray):
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        a, b, words = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        first = np.cumsum(n) - n
        place = mix(ragged(np.ones(len(n), np.int64), n).astype(np.uint64))
        at = ragged(first, n + 1)                       # the prefix's end among all turns
        self.owner = np.repeat(np.arange(len(n)), n + 1)
        self.depth = at - first[self.owner]
        self.size = n[self.owner]
        self.words = np.where(self.depth > 0, np.append(0, words)[at], 0)
        self.a, self.b = (self._sums(x, place, at, first) for x in (a, b))

    def _sums(self, name: np.ndarray, place: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.zeros(len(name) + 1, np.uint64)
        np.cumsum(mix(name.view(np.uint64) + place), out=total[1:])
        return (total[at] - total[first][self.owner]).view(np.int64)

    def parent(self, names: np.ndarray) -> np.ndarray:
        return np.where(self.depth > 0, np.append(0, names[:-1]), 0)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      list(columns))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turns) with the sequence's name."""
    for batch in batches:
        p = _Paths(batch.column(1))
        end = p.depth == p.size
        yield _batch(conv_id=batch.column(0), turns=batch.column(1), depth=p.depth[end], a=p.a[end], b=p.b[end])


def _proper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the proper prefixes of (turns)."""
    for batch in batches:
        p = _Paths(batch.column(0))
        cut = p.depth < p.size
        yield _batch(depth=p.depth[cut], a=p.a[cut], b=p.b[cut])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every prefix of (turns, conv_id, weight, leaf), with its parent's name."""
    for batch in batches:
        p = _Paths(batch.column(0))
        conv, weight, leaf = (batch.column(k).to_numpy(zero_copy_only=False)[p.owner] for k in (1, 2, 3))
        yield _batch(depth=p.depth, a=p.a, b=p.b, parent_a=p.parent(p.a), parent_b=p.parent(p.b), words=p.words,
                     conv_id=conv, weight=weight, leaf=leaf)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each sequence (turns, values of its own nodes, the deepest last) adds to the sums of its prefixes."""
    for batch in batches:
        p = _Paths(batch.column(0))
        own = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        value = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        last = np.cumsum(own)
        total = np.append(0, np.cumsum(value))
        above = p.size + 1 - own[p.owner]               # prefixes of other conversations
        start = (last - own)[p.owner] + np.maximum(p.depth - above, 0)
        yield _batch(depth=p.depth, a=p.a, b=p.b, saved=total[last][p.owner] - total[start])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (depth, a, b, conv_id) as chunks of decimal ids, joined by commas."""
    now, ids = None, []

    def chunk() -> pa.RecordBatch:
        return _batch(depth=[now[0]], a=[now[1]], b=[now[2]], first=[ids[0]], ids=[",".join(map(str, ids))])

    for batch in batches:
        for *name, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (name != now or len(ids) == CHUNK):
                yield chunk()
                ids = []
            now = name
            ids.append(conv)
    if ids:
        yield chunk()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each name's sorted chunks (depth, a, b, first, ids), one chunk in memory at a time."""
    now, digest = None, None
    for batch in batches:
        out = []
        for depth, a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, a, b) == now:
                digest.update(b",")
            else:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (depth, a, b), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield _batch(**dict(zip((*NAME, "ends_sha256"), map(list, zip(*out)))))
    if now is not None:
        yield _batch(**dict(zip((*NAME, "ends_sha256"), ([x] for x in (*now, digest.hexdigest())))))


def end_lists(named: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of rows (depth, a, b, conv_id), however many have one name."""
    order = [*NAME, "conv_id"]
    chunks = named.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, a long, b long, first long, ids string")
    return chunks.repartition(*NAME).sortWithinPartitions(*NAME, "first").mapInArrow(
        _digests, "depth long, a long, b long, ends_sha256 string")


def _parents(nodes: DataFrame) -> DataFrame:
    """(depth, a, b, parent_conv_id) of the nodes below the root."""
    bound = F.greatest(F.lit(HOT_LEAST), F.lit(nodes.count() // HOT_SHARE))
    key = [F.col("depth").alias("of_depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b")]
    parents = nodes.where("n_children > 0").select(*key, F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > bound).alias("hot"))
    hot, cold = parents.where("hot").drop("hot"), parents.where("not hot").drop("hot")
    below = nodes.where("depth > 0").select(*NAME, (F.col("depth") - 1).alias("of_depth"), "parent_a", "parent_b")
    on = ["of_depth", "parent_a", "parent_b"]
    return below.join(F.broadcast(hot), on).unionByName(      # fewer than HOT_SHARE rows
        below.join(F.broadcast(hot), on, "left_anti").join(cold, on)).select(*NAME, "parent_conv_id")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of rows (conv_id, turns) as ``sequences`` gives them: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (sum over the subtree of (n_convs - 1) times the words of a node's last turn) and
    ends_sha256 (SHA-256 of the decimal ids of members without further turns, ascending, comma-joined)."""
    prepare(conversations.sparkSession)
    named = saved(conversations.select("conv_id", "turns").mapInArrow(
        _whole, f"conv_id long, turns {_SEQUENCE}, depth long, a long, b long"), "conversations")
    collapsed = saved(named.groupBy(*NAME).agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.min_by("turns", "conv_id").alias("turns")),
        "sequences")
    proper = collapsed.select("turns").mapInArrow(_proper, "depth long, a long, b long").distinct()
    leaves = collapsed.join(proper, NAME, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    marked = collapsed.join(leaves, "conv_id", "left").select(
        "turns", "conv_id", "weight", F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    nodes = saved(marked.mapInArrow(
        _prefixes, "depth long, a long, b long, parent_a long, parent_b long, words long, conv_id long, weight long, leaf long")
        .groupBy(*NAME).agg(
            F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("n_leaves"),
            *[F.first(c).alias(c) for c in ("words", "parent_a", "parent_b")]), "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(
            F.count("*").alias("n_children"))
    nodes = saved(nodes.join(children, NAME, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")),
                  "trie")
    value = F.struct("depth", ((F.col("n_convs") - 1) * F.col("words")).alias("value"))
    own = nodes.groupBy("conv_id").agg(F.sort_array(F.collect_list(value)).alias("own"))
    sums = collapsed.select("conv_id", "turns").join(own, "conv_id").select(
        "turns", F.transform("own", lambda x: x["value"]).alias("values")).mapInArrow(
            _subtrees, "depth long, a long, b long, saved long").groupBy(*NAME).agg(F.sum("saved").alias("saved_tokens"))
    return nodes.join(_parents(nodes), NAME, "left").join(sums, NAME).join(end_lists(named), NAME, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
