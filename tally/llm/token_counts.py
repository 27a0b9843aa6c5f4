"""Token counts: pieces once per distinct pre-token, summed over pre-token frequencies.

No token ids of a document are made. A text is cut into pre-tokens (and added
special strings, one token each, as the tokenizer cuts them by default); its
count is the sum over distinct pre-tokens of frequency times pieces.

1. Every task counts its pre-tokens (rare ones are dropped whenever its table
   is full, so memory is bounded); the most frequent of the whole corpus, at
   most ``DICTIONARY``, are encoded once each and broadcast.
2. Every document's frequencies are joined with that dictionary. The rest,
   rare pre-tokens by construction, is kept as (pre-token, frequency) rows of
   a written table.
3. Those rows are grouped by pre-token, each distinct one is encoded once, and
   joined back; the pieces are summed per row of the written table.

Null texts count as empty: no bytes, no tokens. Repeated rows (and repeated
or null ids) stay rows of their own. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, saved

DICTIONARY = 300_000        # broadcast pre-tokens, at most (about 20 bytes each)
TASK_TABLE = 400_000        # distinct pre-tokens that a task counts at a time
#: How byte-level BPE cuts a text (fixed value of the vocabulary file), with its commonest case, words, first:
#: no other alternative begins like one, so the order doesn't matter.
PATTERN = r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"


class Cutter:
    """Pre-tokens of a text, and the number of special strings in it."""

    def __init__(self, specials: list[str]):
        self.find = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(specials, key=len, reverse=True))) \
            if specials else None
        self.first = tuple(specials)

    def __call__(self, text: str) -> tuple[list[str], int]:
        if not any(x in text for x in self.first):
            return self.find(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self.find(part)], len(parts) - 1


_encoders: dict[str, object] = {}


def _pieces(path: str, words: list[str]) -> list[int]:
    """Tokens of each pre-token."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(path)
        encoder.no_truncation()
        encoder.no_padding()
        encoder.encode_special_tokens = True        # special strings were cut out before
        _encoders[path] = encoder
    return [len(e.ids) for e in _encoders[path].encode_batch_fast(words, add_special_tokens=False)]


def _frequent(specials: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = Cutter(specials), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(cut(text)[0])
            if len(counts) > TASK_TABLE:
                least = 1
                while len(counts) > TASK_TABLE // 2:
                    least += 1
                    counts = Counter({w: n for w, n in counts.items() if n >= least})
        kept = [(w, n) for w, n in counts.items() if n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                          pa.array([n for _, n in kept], pa.int64())], ["word", "n"])
    return run


def _encode(path: str) -> Callable:
    """(word, pieces) of rows (word, ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_pieces(path, words) if words else [], pa.int64())],
                                             ["word", "pieces"])
    return run


def _sums(specials: list[str], late) -> Callable:
    """(uid, id, n_bytes, known, words, freqs): known is the sum over the dictionary's pre-tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = Cutter(specials), late.value
        context = TaskContext.get()
        uid = (context.partitionId() if context else 0) << 40
        for batch in batches:
            sizes, sums, words, freqs = [], [], [], []
            for text in batch.column(1).to_pylist():
                tokens, total = cut(text) if text else ([], 0)
                rare_w, rare_n = [], []
                for word, n in Counter(tokens).items():
                    pieces = known.get(word)
                    if pieces is None:
                        rare_w.append(word)
                        rare_n.append(n)
                    else:
                        total += n * pieces
                sizes.append(len(text.encode()) if text else 0)
                sums.append(total)
                words.append(rare_w)
                freqs.append(rare_n)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + n), pa.int64()), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(sums, pa.int64()), pa.array(words, pa.list_(pa.string())), pa.array(freqs, pa.list_(pa.int64()))],
                ["uid", "id", "n_bytes", "known", "words", "freqs"])
            uid += n
    return run


def specials_of(path: str) -> list[str]:
    """The added special strings that the tokenizer file names."""
    import json

    with open(path, encoding="utf-8") as f:
        return [x["content"] for x in json.load(f).get("added_tokens", [])]


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, for a byte-level BPE tokenizer file at ``path``.

    The file has to be at the same path on driver and executors.
    """
    spark = prepare(docs.sparkSession)
    specials = specials_of(path)
    text = F.col(text_col).cast("string")
    id_type = dict(docs.dtypes)[id_col]
    frequent = (docs.select(text.alias("text")).mapInArrow(_frequent(specials), "word string, n long")
                .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY))
    dictionary = frequent.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
        _encode(path), "word string, pieces long").collect()
    late = spark.sparkContext.broadcast({r["word"]: r["pieces"] for r in dictionary})
    rows = saved(docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(
        _sums(specials, late), f"uid long, id {id_type}, n_bytes long, known long, words array<string>, freqs array<long>"),
        "token-sums")
    rare = rows.select("uid", F.explode(F.arrays_zip("words", "freqs")).alias("x")).select(
        "uid", F.col("x.words").alias("word"), F.col("x.freqs").alias("n"))
    pieces = saved(rare.groupBy("word").agg(F.lit(1).alias("one")).select("word").mapInArrow(
        _encode(path), "word string, pieces long"), "token-pieces")
    missing = rare.join(pieces, "word").groupBy("uid").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    return rows.select("uid", "id", "n_bytes", "known").join(missing, "uid", "left").select(
        F.col("id").alias(id_col), "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens"))
