"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents. Suspicious tokens
(letters mixed with digits or marks, digits and marks that may stand for
letters, letters spaced out, letters repeated three times or more) are decoded
at any length: every symbol of the token is a column of a lattice, whose edges
emit the letters that the symbol may stand for, or nothing for separators and
repeats, at a channel cost; Viterbi search finds the likeliest letters under the
trigram model. Tokens with separators are also decoded with edges that emit a
word boundary for them, and count with the words of both readings, as tokens
with marks at their ends do with and without these. The restored text is then
scored.

The score model is a lexicon of words and word beginnings: of the training
rows (a bounded sample of labelled ones) it counts in how many toxic and other
documents each occurs, and keeps those whose share of toxic documents is
above the base rate by a likelihood ratio that chance seldom reaches among so
many entries; the share counts by its lower confidence bound. A document's
score is the noisy-or of its words' shares with a floor for the rest.

Null and empty texts score the floor, the toxic share of training rows without
any lexicon entry. Without training rows everything scores 0. Rows are scored
on their own, so repeats and ties need no rule. Extra columns are ignored; an
empty table gives no rows. Labels, languages, sources and ids are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.ngrams import labelled_sample
from tally.llm.store import prepare, saved, schema_of

#: The letters that a symbol may stand for besides itself (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "#": "h"}
SEPARATORS = " .-_*~'`^,:;/\\#%&="
LEET_COST, SKIP_COST, DROP_MARK_COST, DROP_LEET_COST = 1.0, 0.2, 2.5, 7.0
REPEAT_COST, DOUBLE_COST = 0.5, 4.0     # of dropping a repeat from a run of three or more, and from a double letter

ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâáóòôúùûíìîïñçœæ"
_INDEX = {c: i + 1 for i, c in enumerate(ALPHABET)}
SIZE = len(ALPHABET) + 2            # 0: word boundary, last: any other letter
LABELLED_BOUND = 20_000             # labelled rows that the lexicon is fitted on, at most
MIN_DOCS = 3                        # toxic training rows that hold an entry
MIN_SHARE = 0.3                     # toxic share of an entry, at least
Z = 1.0                             # of the lower confidence bound
PREFIXES = range(4, 9)

_SPACED = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*]{1,2}){2,}[^\W_](?!\S)")
_ENDS = re.compile(r"^\W+|\W+$")
_EDGES = re.compile(rf"^[^\w{re.escape(''.join(LEET))}]+|[^\w{re.escape(''.join(LEET))}]+$")     # without marks that may be letters
_LEET = re.compile(f"[{re.escape(''.join(LEET))}]")
_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_SEPARATED = re.compile(rf"[^{re.escape(SEPARATORS)}][{re.escape(SEPARATORS)}]+[^{re.escape(SEPARATORS)}]")
_CLEAN = re.compile(r"^[^\W\d_]+$")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")


def _codes(words: list[str]) -> np.ndarray:
    """Symbol numbers of words, each between two boundaries."""
    return np.fromiter((_INDEX.get(c, SIZE - 1) if c != " " else 0 for c in " " + " ".join(words) + " "), np.int32)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (code, n) of the letter trigrams of a task's texts; each distinct word is coded once a batch."""
    totals = np.zeros(SIZE ** 3, np.int64)
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(_WORD.findall(text.lower()))
        if not counts:
            continue
        code = _codes(list(counts))
        ends = np.flatnonzero(code == 0)
        weight = np.zeros(len(code), np.int64)
        lengths = np.diff(ends)         # a trigram belongs to the word in which it ends
        weight[1:] = np.repeat(np.fromiter(counts.values(), np.int64), lengths)[:len(code) - 1]
        before2 = np.concatenate([[0], code[:-2]])
        before2[code[:-1] == 0] = 0
        tri = (before2 * SIZE + code[:-1]) * SIZE + code[1:]
        totals += np.bincount(tri, weight[1:], minlength=SIZE ** 3).astype(np.int64)
    seen = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(totals[seen])], ["code", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities [two before, one before, next], counted over all documents."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_trigrams, "code int, n long")
    counts = np.zeros(SIZE ** 3)
    for r in rows.groupBy("code").agg(F.sum("n").alias("n")).toLocalIterator():     # at most SIZE ** 3
        counts[r["code"]] = r["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    pair = counts.sum(axis=0)
    one = pair.sum(axis=0)
    base = (one + 1.0) / (one.sum() + SIZE)
    two = (pair + 5.0 * base) / (pair.sum(axis=1, keepdims=True) + 5.0)
    return np.log((counts + 5.0 * two) / (counts.sum(axis=2, keepdims=True) + 5.0)).astype(np.float32)


def decode(token: str, model: list, words: bool = False) -> str:
    """The likeliest letters behind an obfuscated token (lower case); ``words``: separators may be word boundaries."""
    # state: the last two symbols -> (score, the last letter, the path as (path before, text))
    states: dict[tuple[int, int], tuple] = {(0, 0): (0.0, "", None)}
    token = _RUN.sub(r"\1\1\1", token.lower())      # from three on, more of a symbol say nothing
    for i, c in enumerate(token):
        options: list[tuple[str, float]] = []
        letter = c.isalpha()
        if letter:
            options.append((c, 0.0))
        options += [(x, LEET_COST) for x in LEET.get(c, "")]
        if c in SEPARATORS:
            options.append(("", SKIP_COST))
        elif not letter:
            options.append(("", DROP_LEET_COST if c in LEET else DROP_MARK_COST))
        emitted = [(x, _INDEX.get(x, SIZE - 1) if x else 0, cost) for x, cost in options]
        boundary = words and c in SEPARATORS
        again = {c} if letter else set(LEET.get(c, ""))
        repeat = REPEAT_COST if token[max(0, i - 2):i + 3].count(c) > 2 else DOUBLE_COST
        new: dict[tuple[int, int], tuple] = {}
        for (a, b), state in states.items():
            score, last, path = state
            follow = model[a][b]
            for x, k, cost in emitted:
                if not x:
                    value = score - cost
                    if (a, b) not in new or value > new[a, b][0]:
                        new[a, b] = (value, last, path)
                else:
                    value = score - cost + follow[k]
                    if (b, k) not in new or value > new[b, k][0]:
                        new[b, k] = (value, x, (path, x))
            if boundary and b:
                value = score - SKIP_COST + follow[0]
                if (0, 0) not in new or value > new[0, 0][0]:
                    new[0, 0] = (value, "", (path, " "))
            if last in again:                           # one more of a repeated letter
                value = score - repeat
                if (a, b) not in new or value > new[a, b][0]:
                    new[a, b] = (value, last, path)
        states = new
    best = max(((s + (model[a][b][0] if b or path is None else 0.0), path) for (a, b), (s, _, path) in states.items()),
               key=lambda x: x[0])
    out, path = [], best[1]
    while path is not None:
        path, text = path
        out.append(text)
    return "".join(reversed(out))


class Restorer:
    """Words of a text after decoding; each distinct suspicious token is decoded once a task."""

    def __init__(self, model: np.ndarray, bound: int = 200_000):
        self.model, self.bound, self.known = model.tolist(), bound, {}

    def _decoded(self, token: str) -> list[str]:
        found = self.known.get(token)
        if found is None:
            found = [decode(token, self.model)]
            if _SEPARATED.search(token):
                found += decode(token, self.model, words=True).split()
            if len(token) <= 64:        # longer ones are decoded each time, which bounds the memory
                if len(self.known) >= self.bound:
                    self.known.clear()
                self.known[token] = found
        return found

    def words(self, text: str) -> set[str]:
        text = text.lower()
        out: set[str] = set()
        for spaced in _SPACED.findall(text):
            out.update(self._decoded(spaced))
        for token in set(text.split()):
            if _CLEAN.match(token):
                out.add(token)
                if _TRIPLE.search(token):
                    out.update(self._decoded(token))
                continue
            core, wide = _ENDS.sub("", token), _EDGES.sub("", token)
            if _CLEAN.match(core):
                out.add(core)
                if _TRIPLE.search(core):
                    out.update(self._decoded(core))
            elif _LETTER.search(core):
                out.update(_WORD.findall(core))
                out.update(self._decoded(core))
            elif _LEET.search(core):
                out.update(self._decoded(core))
            if wide != core and _LEET.search(wide):     # marks at the ends that may be letters
                out.update(self._decoded(wide))
        out.discard("")
        return out


def entries(word: str) -> list[str]:
    """The word and its beginnings, as lexicon entries."""
    return [f"{word}$", *[word[:k] for k in PREFIXES if len(word) >= k]]


def _evidence(late) -> Callable:
    """(entry, n): texts of a task's batch that hold an entry, of the wanted ones if there are such."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, wanted = late.value
        restorer = Restorer(model)
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                held = {x for w in (restorer.words(text) if text else ()) for x in entries(w)}
                counts.update(held if wanted is None else held & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["entry", "n"])
    return run


def _score(late, keep: int) -> Callable:
    """The kept columns and score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon, floor = late.value
        restorer = Restorer(model)
        beginnings = {x[:4] for x in lexicon if not x.endswith("$")}
        for batch in batches:
            scores = []
            for text in batch.column(keep).to_pylist():
                clean = 1.0 - floor
                for word in restorer.words(text) if text else ():
                    best = lexicon.get(f"{word}$", 0.0)
                    if word[:4] in beginnings:
                        best = max(best, *[lexicon.get(word[:k], 0.0) for k in PREFIXES])
                    clean *= 1.0 - best
                scores.append(1.0 - clean)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:keep], "score"])
    return run


def fit_lexicon(docs: DataFrame, labels: DataFrame, model: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "toxic", bound: int = LABELLED_BOUND) -> tuple[dict[str, float], float]:
    """Entry -> how certainly it makes a document toxic; and the floor score."""
    spark = prepare(docs.sparkSession)
    sample = saved(labelled_sample(labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("_label_id"), (F.col(label_col) == 1).alias("_toxic")), "_label_id", bound), "labelled")
    # Copies are no evidence of their own: texts that differ in case and white space only count once a label.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    training = saved(docs.join(F.broadcast(sample), F.col(id_col) == F.col("_label_id"))
                     .select(text.alias("text"), "_toxic").groupBy(F.sha2(plain.cast("binary"), 256).alias("_same"), "_toxic")
                     .agg(F.min("text").alias("text")), "training")
    size = {r["_toxic"]: r["count"] for r in training.groupBy("_toxic").count().collect()}
    toxic, total = size.get(True, 0), sum(size.values())
    if not toxic:
        return {}, 0.0

    def held(rows: DataFrame, wanted: set | None) -> DataFrame:
        late = spark.sparkContext.broadcast((model, wanted))
        return rows.select("text").mapInArrow(_evidence(late), "entry string, n long").groupBy("entry").agg(
            F.sum("n").alias("n"))

    bad = saved(held(training.where("_toxic"), None).where(F.col("n") >= MIN_DOCS), "toxic-entries")
    often = {r["entry"]: r["n"] for r in bad.collect()}     # of at most ``bound`` texts, whatever the corpus holds
    fine = {r["entry"]: r["n"] for r in held(training.where("not _toxic"), set(often)).collect()}
    base, lexicon = toxic / total, {}
    for entry, t in often.items():
        n = t + fine.get(entry, 0)
        p = t / n
        gain = t * math.log(p / base) + ((n - t) * math.log((1 - p) / (1 - base)) if n > t else 0.0)
        # a likelihood ratio that chance seldom reaches among so many entries
        if p > base and gain >= math.log(len(often) + 1):
            lexicon[entry] = float((p + Z * Z / (2 * n) - Z * math.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)))
                                   / (1 + Z * Z / n))
    return {x: p for x, p in lexicon.items() if p >= MIN_SHARE}, base * base


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the id) plus score (0 to 1). ``labels``: the rows that may be learned from."""
    spark = prepare(docs.sparkSession)
    model = character_model(docs, text_col)
    lexicon, floor = fit_lexicon(docs, labels, model, id_col=id_col, text_col=text_col, label_col=label_col)
    late = spark.sparkContext.broadcast((model, lexicon, floor))
    names = keep or [id_col]
    sent = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("_text"))
    return sent.mapInArrow(_score(late, len(names)), schema_of(sent.schema.fields[:-1], "score double"))
