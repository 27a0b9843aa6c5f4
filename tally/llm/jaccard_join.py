"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents with equal shingle sets are one class; only classes are joined.
All sets are ordered alike, from rare to frequent: by the hashed document
frequency of a shingle (a counter for all documents, in steps of a tenth), then
by its 64-bit name. Other shingles of a counter can only make one seem more
frequent, by a share of the corpus of about a set's size over ``COUNTERS``. Two sets with Jaccard similarity >= t of sizes n, m share at
least ceil(t * n) shingles, so their first ``n - ceil(t * n) + l`` shingles
share at least l. Every class writes its longest prefix (l = ``max_match``).
A pair must share min(l, l') prefix shingles, and as many more as its sizes
demand: the shingles behind the prefixes add at most
max(n - prefix, m - prefix') to the overlap (``_needed``). Of k needed ones the
rarest lies outside the k - 1 most frequent shingles of either prefix, so a
longer prefix lets a document ignore as many more of its frequent shingles:
each class picks the l for which the measured document frequencies of the
others, its estimated candidates, add up to the least.

Verification runs in rounds, so that a group of thousands of near copies is
not expanded into all its pairs. First each class meets the one centre it
shares most prefix shingles with (the candidate whose shingles are the most
frequent, as those of a group's original are); confirmed links are contracted
to components. Candidates that still lie in different components follow:
those of one group (which share half a prefix with a centre, or are its
candidates) in cells of two
blocks of at most about ``CELL`` classes, compared within a task; those of
different groups as single pairs. A pair left out is inside one component
already, so the components are those of all links. No candidate, bucket or
partner is capped.

Nulls and texts without words have empty sets and link with nothing. A text
of fewer words than the shingle size is one shingle. Repeated rows (and
repeated ids) are rows of their own; ties have no influence, components are
the smallest id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.components import components
from tally.llm.store import ARROW_ROWS, prepare, saved, sized
from tally.llm.textbytes import LOWER, SPACE, blocks, shingles

#: Counters of the shingles' document frequencies, a byte of the broadcast order each (a power of two).
COUNTERS = 1 << 22
PAGE = 1 << 12                  # counters of a row
FAN_IN = 256                    # tasks whose counts are added in one group
_COUNTER = np.uint64(COUNTERS - 1)
BROADCAST_COPIES = 2_000_000    # row numbers (8 bytes each) of copies that are broadcast, beyond it a shuffle join
BROADCAST_IDS = 200_000         # rows of a broadcast id list, beyond it a shuffle join
READ_COST = 0.2                 # of one more prefix shingle, in candidates
MAX_MATCH = 8
CELL = 64                       # classes of a block


def _pages(size: int) -> Callable:
    """(task, page, counts): the documents of a task that hold a shingle of each counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        count, held, waiting = np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, _, names, at = block.words(SPACE_NOT, LOWER)
                for k in range(len(block)):
                    held.append(shingles(names, at[k], at[k + 1], size) & _COUNTER)
                    waiting += len(held[-1])
                    if waiting >= COUNTERS:
                        count += np.bincount(np.concatenate(held).view(np.int64), minlength=COUNTERS)
                        held, waiting = [], 0
        if waiting:
            count += np.bincount(np.concatenate(held).view(np.int64), minlength=COUNTERS)
        pages = count.reshape(-1, PAGE)
        some = np.flatnonzero(pages.any(axis=1))
        for at in range(0, len(some), ARROW_ROWS):
            part = some[at:at + ARROW_ROWS]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(part), context.partitionId() if context else 0, np.int64)), pa.array(part),
                pa.array([_packed(pages[i]) for i in part], pa.binary())], ["task", "page", "counts"])
    return run


def _packed(counts: np.ndarray) -> bytes:
    """The counts in as many bytes each as the largest one takes."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // PAGE}").astype(np.int64)


def _added(key: tuple, pages: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(PAGE, np.int64)
    for data in pages["counts"]:
        total += _unpacked(data)
    return pd.DataFrame({"task": [key[0]], "page": [key[1]], "counts": [_packed(total)]})


def frequency_levels(texts: DataFrame, size: int) -> np.ndarray:
    """A byte per counter: 7 times log2 of the documents that hold one of its shingles.

    ``texts`` has one column. Counts of all documents; those of ``FAN_IN``
    tasks are added at a time, so that no group grows with the corpus. The
    driver gets one byte for each of the ``COUNTERS``.
    """
    pages = saved(texts.mapInArrow(_pages(size), "task long, page long, counts binary"), "jaccard-counts")
    last = pages.agg(F.max("task")).first()[0] or 0
    while last:
        pages = saved(pages.groupBy(F.expr(f"task div {FAN_IN}").alias("task"), "page")
                      .applyInPandas(_added, pages.schema), "jaccard-counts")
        last //= FAN_IN
    levels = np.zeros((COUNTERS // PAGE, PAGE), np.uint8)
    for row in pages.select("page", "counts").collect():
        levels[row["page"]] = np.minimum(255, np.round(7 * np.log2(_unpacked(row["counts"]) + 1)))
    return levels.ravel()


SPACE_NOT = ~SPACE


def _fingerprint(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def required(n: int, percent: int) -> int:
    """ceil(percent / 100 * n)."""
    return (percent * n + 99) // 100


def _sets(size: int, percent: int, max_match: int, levels) -> Callable:
    """(uid, id, n, fingerprint, prefix) of each row; prefix in the common order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        uid = (context.partitionId() if context else 0) << 40
        level = levels.value
        for batch in batches:
            sizes, prints, prefixes = [], [], []
            for block in blocks(batch.column(1)):
                _, _, names, at = block.words(SPACE_NOT, LOWER)
                for k in range(len(block)):
                    tokens = shingles(names, at[k], at[k + 1], size)
                    n = len(tokens)
                    sizes.append(n)
                    prints.append(_fingerprint(tokens) if n else None)
                    need = required(n, percent)
                    if 100 * n < percent * (n + 1):     # no different set is similar enough
                        prefixes.append(np.zeros(0, np.int64))
                        continue
                    width = min(n, n - need + max_match)
                    head = tokens[np.argsort(level[tokens & _COUNTER], kind="stable")[:width]]
                    prefixes.append(head.view(np.int64))
            ends = np.zeros(len(prefixes) + 1, np.int32)
            np.cumsum([len(x) for x in prefixes], out=ends[1:])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(uid, uid + len(sizes), dtype=np.int64)), batch.column(0),
                pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["uid", "id", "n", "print", "prefix"])
            uid += len(sizes)
    return run


def _full(size: int) -> Callable:
    """(cls, tokens) of rows whose set has the wanted fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, cls, keys, sets = batch.column(2).to_pylist(), batch.column(1).to_pylist(), [], []
            for block in blocks(batch.column(0)):
                _, _, names, at = block.words(SPACE_NOT, LOWER)
                for k in range(len(block)):
                    tokens = shingles(names, at[k], at[k + 1], size)
                    if len(tokens) and _fingerprint(tokens) == wanted[block.first + k]:
                        keys.append(cls[block.first + k])
                        sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["cls", "tokens"])
    return run


def _confirm(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for x, y in zip(left, right):
                a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                if len(a) > len(b):
                    a, b = b, a
                where = np.searchsorted(b, a)
                where[where == len(b)] = 0
                shared = int(np.count_nonzero(b[where] == a))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    return run


def _cells(percent: int) -> Callable:
    """The links between classes of different components in a cell's one or two blocks."""
    def run(cell):
        sets = [np.frombuffer(x, np.uint64) for x in cell["tokens"]]
        sizes = np.array([len(x) for x in sets])
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        part, side, own = cell["component"].to_numpy(), cell["side"].to_numpy(), cell["own"].iloc[0]
        shared = np.zeros((len(sets), len(sets)), np.int32)
        edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        for lo, hi in zip(edge[:-1], edge[1:]):
            if hi - lo > 1:
                at = owner[lo:hi]
                shared[np.ix_(at, at)] += 1
        x, y = np.triu_indices(len(sets), 1)
        keep = (part[x] != part[y]) & (own | (side[x] != side[y]))
        x, y = x[keep], y[keep]
        both = shared[x, y]
        hit = 100 * both >= percent * (sizes[x] + sizes[y] - both)
        cls = cell["cls"].to_numpy()
        return pd.DataFrame({"a": cls[x[hit]], "b": cls[y[hit]]})
    return run


def _whole_sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, text_col: str, id_col: str, size: int) -> DataFrame:
    """(cls, tokens): the whole sets of the classes ``ids`` (cls), from the texts."""
    wanted = saved(ids.join(classes.select("cls", "id", "print"), "cls"), "jaccard-wanted")
    known = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("own_id"))
    picked = known.join(sized(wanted, BROADCAST_IDS), F.col("own_id").eqNullSafe(F.col("id")))
    return saved(picked.select("text", "cls", "print").mapInArrow(_full(size), "cls long, tokens binary")
                 .dropDuplicates(["cls"]), "jaccard-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets reach the similarity."""
    whole = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
             .join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
             .select("a", "b", "x", "y"))
    return saved(whole.mapInArrow(_confirm(percent), "a long, b long"), "jaccard-links")


def _needed(percent: int, n: str, m: str, l_n: str, l_m: str):
    """Prefix shingles that a linking pair shares at least, from its sizes and its l."""
    rest = [f"(({percent} * {x} + 99) div 100 - {k})" for x, k in ((n, l_n), (m, l_m))]
    overlap = f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"
    return F.expr(f"greatest(least({l_n}, {l_m}), {overlap} - greatest({rest[0]}, {rest[1]}))")


def _within_groups(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components of one group. ``open_``: cls, component, grp.

    Members are dealt to blocks by hash: a component of CELL classes or more
    has blocks of its own, which need not meet each other; the smaller ones
    share the group's mixed blocks.
    """
    per_part = open_.groupBy("grp", "component").agg(F.count("*").alias("size"))
    mixed = per_part.where(F.col("size") < CELL).groupBy("grp").agg(F.sum("size").alias("mixed_size"))
    count = lambda c: F.ceil(F.col(c) / CELL)
    dealt = (open_.join(per_part, ["grp", "component"]).join(mixed, "grp", "left")
             .withColumn("pure", F.when(F.col("size") >= CELL, F.col("component")))
             .withColumn("block", F.when(F.col("size") >= CELL, F.pmod(F.xxhash64("cls"), count("size")))
                         .otherwise(F.pmod(F.xxhash64("component"), count("mixed_size")))))
    dealt = saved(dealt.select("grp", "pure", "block", "cls", "component"), "jaccard-blocks")
    block = dealt.select("grp", F.struct("pure", "block").alias("b")).distinct()
    pair = block.join(block.select("grp", F.col("b").alias("c")), "grp").where(
        ((F.col("b") < F.col("c")) & ~F.col("b.pure").eqNullSafe(F.col("c.pure")))
        | ((F.col("b") <= F.col("c")) & F.col("b.pure").isNull() & F.col("c.pure").isNull()))
    cell = saved(pair.withColumn("own", F.col("b") == F.col("c")), "jaccard-cells")
    sides = cell.select("grp", F.col("b").alias("at"), "b", "c", "own", F.lit(0).alias("side")).unionByName(
        cell.where(~F.col("own")).select("grp", F.col("c").alias("at"), "b", "c", "own", F.lit(1).alias("side")))
    rows = (dealt.withColumn("at", F.struct("pure", "block")).join(sides, ["grp", "at"])
            .withColumn("cell", F.xxhash64("grp", "b", "c")).select("cell", "own", "side", "cls", "component")
            .join(sets, "cls"))
    return saved(rows.groupBy("cell").applyInPandas(_cells(percent), "a long, b long"), "jaccard-links")


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                       percent: int = 90, max_match: int = MAX_MATCH) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``.

    Rows link when 100 * |intersection| >= percent * |union| of their sets of
    distinct ``size``-word shingles (words between white space, A-Z lowered);
    component_id is the smallest id reachable by links, the row's own included.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = dict(texts.dtypes)["id"]

    levels = spark.sparkContext.broadcast(frequency_levels(texts.select("text"), size))
    rows = saved(texts.mapInArrow(_sets(size, percent, max_match, levels),
                                  f"uid long, id {id_type}, n long, print binary, prefix array<long>"), "jaccard-rows")
    classes = saved(rows.where("n > 0").groupBy("print").agg(
        F.min(F.struct("uid", "id")).alias("first"), F.max("n").alias("n"), F.count("*").alias("members"))
        .select("print", F.col("first.uid").alias("cls"), F.col("first.id").alias("id"), "n", "members"), "jaccard-classes")

    copies = saved(rows.where("n > 0").select("uid", "print").join(
        classes.where("members > 1").select("print", "cls"), "print").where("uid <> cls").select("uid"), "jaccard-copies")
    postings = (rows.where("n > 0").join(sized(copies, BROADCAST_COPIES), "uid", "left_anti")
                .select(F.col("uid").alias("cls"), "n", F.posexplode("prefix").alias("pos", "token")))
    shared = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    base = F.expr(f"n - (({percent} * n + 99) div 100)")        # prefix of l shingles more
    found = saved(postings.join(shared, "token").select(
        "token", "cls", "n", "df", (F.col("pos") - base + 1).alias("least_l")), "jaccard-postings")

    # The cheapest l of each class, from its shared prefix shingles in the order of their frequency.
    # One shuffle brings a class's rows together; its list is as long as its prefix at most.
    own = found.repartition("cls").groupBy("cls", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token", "least_l"))).alias("own"))

    def cost(k: int):
        held = F.filter("own", lambda x: x["least_l"] <= k)
        alone = base + k - F.size(held)         # shingles of no other document come first
        tried = F.slice(held, F.lit(1), F.greatest(base + 1 - alone, F.lit(0)).cast("int"))
        sure = F.expr(f"({percent} * n + 99) div 100 >= {k}")   # l can't be more than what is shared for certain
        return F.when(sure if k > 1 else F.lit(True), F.aggregate(
            tried, F.lit(READ_COST * k), lambda a, x: a + x["df"] - 1.0)).otherwise(F.lit(1e300))

    # rate: mean number of other documents that hold a shingle of the prefix
    rate = F.aggregate("own", F.lit(0.0), lambda a, x: a + x["df"] - 1.0) / (base + max_match)
    options = sorted({1, 2, 4, max_match})
    chosen = own.select("cls", "n", "own", rate.alias("rate"), F.array_min(F.array(*[
        F.struct(cost(k).alias("cost"), F.lit(k).alias("l")) for k in options if k <= max_match]))["l"].alias("l"))
    # place: that of a shingle in the class's prefix by rarity, those of no other document first
    held = chosen.withColumn("width", base + F.col("l")).withColumn("own", F.filter("own", lambda x: x["least_l"] <= F.col("l")))
    used = saved(held.select("cls", "n", "l", "rate", "width", F.size("own").alias("count"), F.posexplode("own").alias("pos", "x"))
                 .select("x.token", "cls", "n", "l", "rate", "width", (F.col("pos") + F.col("width") - F.col("count")).alias("place")),
                 "jaccard-prefixes")

    # Round 1: each class against the centre it shares most prefix shingles with.
    fits = lambda n, m: (100 * F.least(n, m) >= percent * F.greatest(n, m))
    centre = used.groupBy("token").agg(F.max(F.struct("rate", F.xxhash64("cls").alias("h"), "cls", "n", "l")).alias("c"))
    first = (used.join(centre.select("token", F.col("c.cls").alias("centre"), F.col("c.n").alias("m"),
                                     F.col("c.l").alias("k")), "token")
             .where((F.col("cls") != F.col("centre")) & fits(F.col("n"), F.col("m")))
             .groupBy("cls", "centre", "n", "m", "l", "k", "width").agg(F.count("*").alias("both"))
             .where((F.col("both") >= _needed(percent, "n", "m", "l", "k")) | (2 * F.col("both") >= F.col("width")))
             .groupBy("cls").agg(F.max(F.struct("both", "centre")).alias("best"))
             .select(F.col("cls").alias("a"), F.col("best.centre").alias("b")))
    tried = saved(first, "jaccard-first")
    ends = tried.select(F.col("a").alias("cls")).unionByName(tried.select(F.col("b").alias("cls"))).distinct()
    sets = _whole_sets(ends, docs, classes, text_col, id_col, size)
    links = _verified(tried, sets, percent)
    parts = components(links, "a", "b", "jaccard-cc").withColumnRenamed("node", "cls")
    groups = components(tried, "a", "b", "jaccard-cc").select(F.col("node").alias("cls"), F.col("component").alias("grp"))
    placed = saved(groups.join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls")),
                   "jaccard-placed")

    # Round 2: candidates of one group that lie in several components still.
    several = placed.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    inside = _within_groups(placed.join(several.select("grp"), "grp", "left_semi"), sets, percent)

    # Round 3: candidates of different groups (a class that met no centre is its own), by a shingle that is
    # among the rare enough ones of both.
    spread = used.join(placed.select("cls", "grp"), "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    split = spread.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi")
    open_ = saved(spread.join(split.select("token"), "token", "left_semi"), "jaccard-open")
    left, right = (open_.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "n", "l", "grp", "width", "place")])
                   for s in "ab")
    needed = _needed(percent, "n_a", "n_b", "l_a", "l_b")
    second = (left.join(right, "token")
              .where((F.col("cls_a") < F.col("cls_b")) & (F.col("grp_a") != F.col("grp_b"))
                     & fits(F.col("n_a"), F.col("n_b")) & (F.col("place_a") <= F.col("width_a") - needed)
                     & (F.col("place_b") <= F.col("width_b") - needed))
              .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), needed.alias("need")).distinct())
    # Of these, the pairs that share as many prefix shingles as they need (a prefix bounds each list).
    held = saved(open_.groupBy("cls").agg(F.collect_list("token").alias("held")), "jaccard-held")
    second = (saved(second, "jaccard-pairs").join(held.select(F.col("cls").alias("a"), F.col("held").alias("x")), "a")
              .join(held.select(F.col("cls").alias("b"), F.col("held").alias("y")), "b")
              .where(F.size(F.array_intersect("x", "y")) >= F.col("need")).select("a", "b"))
    rest = saved(second, "jaccard-second")
    late_ends = rest.select(F.col("a").alias("cls")).unionByName(rest.select(F.col("b").alias("cls"))).distinct()
    across = _verified(rest, _whole_sets(late_ends, docs, classes, text_col, id_col, size), percent)
    every = components(links.unionByName(inside).unionByName(across), "a", "b", "jaccard-cc")

    # Every row by its set's class, every class by its component, every component by its smallest id.
    member = rows.where("n > 0").select("uid", "id", "n", "print").join(classes.select("print", "cls"), "print")
    grouped = member.join(every.withColumnRenamed("node", "cls"), "cls", "left").select(
        "id", "n", F.coalesce("component", "cls").alias("component"))
    grouped = saved(grouped, "jaccard-grouped")
    name = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    return (grouped.join(name, "component").select("id", "n", "component_id")
            .unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))
