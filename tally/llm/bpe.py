"""BPE encoding and decoding with batched numpy merge rounds.

For vocabulary files of BPE over bytes with word ends (lower-cased words, each
ending in a suffixed symbol). ``encode`` gives every text the ids that the
file's own library gives, ``decode`` the text of ids:

1. A block of texts is normalised (NFC, lower case), and cut into words at
   changes of the characters' classes, as array operations over the block. The
   file's special strings are words of their own, found before normalising.
2. Words get 64-bit names; each distinct one that the worker doesn't know yet
   is encoded once. The symbols of all these words lie in one flat array. In
   every round the pairs of neighbours are looked up by binary search over the
   sorted keys of the mergeable pairs, and every word merges its pair of lowest
   rank wherever it stands, leftmost first.
3. Texts take the ids of their words.

A file where a merge uses a symbol that a later merge makes is refused, as
then the lowest pairs of a round would not be independent. A word of more than
``LONG`` times the longest symbol merges, in one round, all pairs that are the
lowest within the reach of the longest symbol: no merge of a lower rank can
come near them, so the result is the same and a long word takes few rounds.

Null and empty texts have no ids, null and empty lists an empty text; ids that
the vocabulary lacks, and nulls, are skipped in decoding. Rows are independent:
repeats and ties need no rule. Extra columns are ignored; an empty table gives
no rows. A worker's memory is bounded by one block (a longer text being one of
its own) and ``KNOWN`` words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, schema_of
from tally.llm.textbytes import BLOCK_BYTES, Block, joined, mix, ragged

KNOWN = 1 << 19             # words that a worker remembers, at most
LONG = 8
NONE = np.int64(1 << 60)    # the rank of pairs that don't merge
_SPACE, _LETTER, _NUMBER, _OTHER, _SPECIAL = range(5)
_MARK = 0xD800              # stands for special string k as code point _MARK + k, which no text holds

# The characters of Unicode 16 that older character tables lack (letters, numbers, lower cases).
NEW_LETTERS = ("1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E "
               "11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0")
NEW_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
NEW_LOWER = ("1C89>1C8A A7CB>264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>19B 10D50-10D65>10D70 "
             "16EA0-16EB8>16EBB")
#: How the file cuts words: these endings after an apostrophe are words with it (fixed values).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACES = "9-D 20 85 A0 1680 2000-200A 2028-2029 202F 205F 3000"


def _ranges(text: str) -> Iterator[tuple[int, int]]:
    for part in text.split():
        first, _, last = part.partition("-")
        yield int(first, 16), int(last or first, 16)


def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for text, kind in ((NEW_LETTERS, _LETTER), (NEW_NUMBERS, _NUMBER), (SPACES, _SPACE)):
        for first, last in _ranges(text):
            out[first:last + 1] = kind
    out[_MARK:0xE000] = _SPECIAL
    return out


def _lower_cases() -> dict[int, int]:
    out = {0x3A3: 0x3C3}        # a capital sigma is lowered alike at the end of a word
    for part in NEW_LOWER.split():
        upper, _, lower = part.partition(">")
        ((first, last),) = _ranges(upper)
        out.update((c, int(lower, 16) + c - first) for c in range(first, last + 1))
    return out


_LOWER = _lower_cases()


def normalised(text: str) -> str:
    """NFC, every character in lower case."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    try:
        text.encode("latin-1")      # no character of _LOWER
    except UnicodeEncodeError:
        text = text.translate(_LOWER)
    return text.lower()


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on, in order."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class Merges:
    """The tables of a vocabulary file, and the merge rounds over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a BPE vocabulary with word ends")
        vocabulary = dict(model["vocab"])
        self.specials = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.size = max([*vocabulary.values(), *self.specials.values()]) + 1
        letters = _byte_letters()
        self.inside = np.array([vocabulary[c] for c in letters], np.int64)
        self.final = np.array([vocabulary[c + suffix] for c in letters], np.int64)
        parts = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([vocabulary[a + b] for a, b in parts], np.int64)
        left = np.array([vocabulary[a] for a, _ in parts], np.int64)
        right = np.array([vocabulary[b] for _, b in parts], np.int64)
        made = np.full(self.size, -1, np.int64)
        made[self.merged] = np.arange(len(parts))
        rank = np.arange(len(parts))
        if (np.maximum(made[left], made[right]) >= rank).any() or len(np.unique(self.merged)) < len(parts):
            raise ValueError(f"{path}: a merge uses a symbol that a later merge makes")
        key = left * self.size + right
        order = np.argsort(key)
        self.keys, self.ranks = np.append(key[order], NONE), np.append(rank[order], NONE)
        self.reach = max(len(t.removesuffix(suffix)) for t in vocabulary)
        text = [b""] * self.size
        for token, i in [*vocabulary.items(), *self.specials.items()]:
            text[i] = token.encode()
        lengths = np.array([len(x) for x in text], np.int64)
        self.text, self.text_end = np.frombuffer(b"".join(text), np.uint8), np.cumsum(lengths)
        self.text_start = self.text_end - lengths

    def spelt(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words given by their bytes, one after another, and sizes."""
        symbol, word = self.inside[data], np.repeat(np.arange(len(size)), size)
        last = np.cumsum(size) - 1
        symbol[last] = self.final[data[last]]
        long = size > LONG * self.reach
        ids, owner = self._rounds(symbol[~long[word]], word[~long[word]], False)
        if long.any():
            more, whose = self._rounds(symbol[long[word]], word[long[word]], True)
            owner = np.concatenate([owner, whose])
            ids = np.concatenate([ids, more])[np.argsort(owner, kind="stable")]
        return ids, np.bincount(owner, minlength=len(size))

    def _rounds(self, symbol: np.ndarray, word: np.ndarray, long: bool) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words (in their order) once nothing merges any more."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            rank = np.full(len(symbol), NONE)           # of the pair that begins at a symbol
            pair = symbol[:-1] * self.size + symbol[1:]
            where = np.searchsorted(self.keys, pair)
            rank[:-1] = np.where((self.keys[where] == pair) & (word[1:] == word[:-1]), self.ranks[where], NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(first, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, first), count)
            open_ = least < NONE
            if not open_.all():
                done.append((symbol[~open_], word[~open_]))
                symbol, word, rank, least = symbol[open_], word[open_], rank[open_], least[open_]
                if not len(symbol):
                    break
            hit = (rank == (_window_least(rank, self.reach) if long else least)) & (rank < NONE)
            hit = _leftmost(hit, rank)
            at = np.flatnonzero(hit)
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word = symbol[keep], word[keep]
        if not done:
            return symbol, word
        ids, owner = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]


def _window_least(rank: np.ndarray, reach: int) -> np.ndarray:
    """The least rank within ``reach`` places to either side."""
    width, have = 2 * reach + 1, 1
    out = np.concatenate([np.full(reach, NONE), rank, np.full(reach, NONE)])
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _leftmost(hit: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``hit`` without the places that overlap the one before them.

    Neighbouring pairs of equal rank are runs of one symbol; every second pair
    of a run merges, from its left end. A run merges if all of it is hit.
    """
    chained = (rank[1:] == rank[:-1]) & (rank[1:] < NONE)
    if not (chained & hit[1:] | chained & hit[:-1]).any():
        return hit
    first = np.flatnonzero(np.append(True, ~chained))
    count = np.diff(np.append(first, len(rank)))
    whole = np.repeat(np.minimum.reduceat(hit, first), count)
    return whole & ((np.arange(len(rank)) - np.repeat(first, count)) % 2 == 0)


class Encoder:
    """Cuts texts into words and remembers the ids of words."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.classes = _classes()
        self.special_ids = np.array(list(merges.specials.values()), np.int64)
        longest_first = sorted(merges.specials, key=len, reverse=True)
        self.mark = {s: chr(_MARK + k) for k, s in enumerate(merges.specials)}
        self.find = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self._forget()

    def _forget(self) -> None:
        self.names, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _plain(self, text: str) -> str:
        if self.find is None or not self.find.search(text):
            return normalised(text)
        out, end = [], 0
        for m in self.find.finditer(text):
            out += [normalised(text[end:m.start()]), self.mark[m.group()]]
            end = m.end()
        return "".join([*out, normalised(text[end:])])

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts and ends of words in them, special string of each word or -1, first word of each text)."""
        plain = [self._plain(t) for t in texts]
        whole = "\n".join(plain) + "\n"
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) == len(whole):
            code, offset = data, None
        else:
            code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
            width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            offset = np.concatenate([[0], np.cumsum(width)])
        kind = self.classes[code]
        begins = np.empty(len(kind), bool)
        begins[0] = kind[0] != _SPACE
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER) | (kind[1:] == _SPECIAL)
        begins &= kind != _SPACE
        # an apostrophe alone before an ending is one word with it; what follows the ending is a word of its own
        alone = np.flatnonzero((code[:-1] == 39) & begins[:-1] & (kind[1:] == _LETTER))
        for ending in ENDINGS:
            n = len(ending)
            at = alone[alone + n < len(code)]
            for k, c in enumerate(ending):
                at = at[code[at + 1 + k] == ord(c)]
            begins[at + 1] = False
            begins[at + n + 1] |= kind[at + n + 1] == _LETTER
        edge = np.flatnonzero(begins | (kind == _SPACE))
        own = begins[edge]
        start, end = edge[own], np.append(edge[1:], len(kind))[own]
        special = np.where(kind[start] == _SPECIAL, code[start].astype(np.int64) - _MARK, -1)
        at = np.searchsorted(start, np.concatenate([[0], np.cumsum([len(p) + 1 for p in plain])]))
        if offset is not None:
            start, end = offset[start], offset[end]
        return data, start, end, special, at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts in them)."""
        data, start, end, special, at = self.cut(texts)
        plain = special < 0
        block = Block(0, data, np.array([0, len(data)]))
        own_start, own_end = start[plain], end[plain]
        size = own_end - own_start
        names = mix(block.names(block.sums(), own_start, own_end) + size.astype(np.uint64))
        distinct, sample, inverse = np.unique(names, return_index=True, return_inverse=True)
        entry = np.zeros(len(start), np.int64)
        entry[plain] = self._known(distinct, data, own_start[sample], size[sample])[inverse]
        first, last = self.first[entry], self.first[entry + 1]
        count = np.where(plain, last - first, 1)
        ids = np.empty(count.sum(), np.int32)
        to = np.cumsum(count) - count
        ids[ragged(to[plain], count[plain])] = self.ids[ragged(first[plain], count[plain])]
        ids[to[~plain]] = self.special_ids[special[~plain]]
        return ids, np.append(to, len(ids))[at]

    def _known(self, names: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entries of words (sorted distinct names, and where each stands), new ones being encoded."""
        if len(self.names) + len(names) > KNOWN:
            self._forget()
        where = np.searchsorted(self.names, names)
        new = np.append(self.names, names[:1])[where] != names if len(self.names) else np.ones(len(names), bool)
        if new.any():
            ids, count = self.merges.spelt(data[ragged(start[new], size[new])], size[new])
            row = len(self.first) - 1 + np.arange(len(count))
            self.first = np.append(self.first, self.first[-1] + np.cumsum(count))
            self.ids = np.append(self.ids, ids.astype(np.int32))
            self.names = np.append(self.names, names[new])
            order = np.argsort(self.names)
            self.names, self.row = self.names[order], np.append(self.row, row)[order]
            where = np.searchsorted(self.names, names)
        return self.row[where]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker's encoder of a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(Merges(path))
    return _encoders[path]


def _parts(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` in all, a larger row being a range of its own."""
    low = total = 0
    for k, n in enumerate(sizes):
        if k > low and total + n > limit:
            yield low, k
            low, total = k, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)


def _encode(path: str, keep: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(keep).to_pylist()]
            for low, high in _parts([len(t) for t in texts], BLOCK_BYTES):
                ids, at = encoder.encode(texts[low:high])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(c.slice(low, high - low) for c in batch.columns[:keep]), lists],
                                                 [*batch.schema.names[:keep], "ids"])
    return run


def _decode(path: str, keep: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _encoder(path).merges
        for batch in batches:
            lists = batch.column(keep)
            for low, high in _parts(lists.value_lengths().fill_null(0).to_pylist(), BLOCK_BYTES // 4):
                part = lists.slice(low, high - low)
                ids = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                at = np.concatenate([[0], np.cumsum(part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
                there = (ids >= 0) & (ids < merges.size)
                there[there] = merges.text_end[ids[there]] > merges.text_start[ids[there]]
                at, ids = np.concatenate([[0], np.cumsum(there)])[at], ids[there]
                text = joined(merges.text, merges.text_start[ids], merges.text_end[ids], at)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(low, high - low) for c in batch.columns), text], [*batch.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, path: str, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id) plus ids: array<int>.

    The file has to be at the same path on driver and executors.
    """
    prepare(docs.sparkSession)
    names = keep or ["doc_id"]
    sent = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("_text"))
    return sent.mapInArrow(_encode(path, len(names)), schema_of(sent.schema.fields[:-1], "ids array<int>"))


def decode(rows: DataFrame, path: str, *, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id), ids and decoded: the symbols of the ids, joined by one space."""
    prepare(rows.sparkSession)
    names = keep or ["doc_id"]
    sent = rows.select(*[F.col(c) for c in names], F.col(ids_col).cast("array<int>").alias("ids"))
    return sent.mapInArrow(_decode(path, len(names)), schema_of(sent.schema.fields, "decoded string"))
