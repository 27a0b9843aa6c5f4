"""Personal data with a skip-chain conditional random field.

Base spans come from fixed patterns. The field adds spans that the patterns
miss but the rest of the document speaks for. Its nodes are mentions: maximal
strings of address or number characters, and the base spans, which are
observed. Node potentials are those of a naive Bayes model of mention shapes,
counted over all documents with the base spans as labels. Chain
edges join mentions next to each other, skip edges join all mentions of one
content in a document (equal letters and digits, equal digits without a country
code, or an equal address) to a hub, however many and far apart they are: a pair
shares a potential that favours one label for both. A hub with base spans among
its mentions has their kind. Sum-product message passing runs over all documents
of a batch at once, each until its own messages settle. Where they swing, they
are damped ever more, after ``ROUNDS`` rounds each of ``DAMPING``; what they have
come to then counts. A mention whose belief in a kind reaches ``CONFIDENCE``
becomes a span, unless it overlaps a base span or breaks its kind's form.

All patterns take time in proportion to the text: a match is tried once per run
of its first characters, as all starts within a run fail alike.

Null and empty texts have no spans. Rows are independent: repeats and ties need
no rule (of equal beliefs the first kind counts). Offsets are code points, end
exclusive. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, schema_of

KINDS = ("email", "ip", "card", "phone")
#: The base patterns (fixed values), leftmost and non-overlapping within a kind.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same matches with one attempt per run of digits; and what follows an address's @.
_IP = re.compile(rf"(?<![0-9]){PATTERNS['ip'].pattern}")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_AT, _DOT = r"(?:@|\s?[(\[]at[)\]]\s?| at )", r"(?:\.|\s?[(\[]dot[)\]]\s?| dot )"
_ADDRESS = re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_ADDRESS_RUN = re.compile(rf"(?<![A-Za-z0-9._%+-]){_ADDRESS.pattern}")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9])+")
_DIGIT = re.compile("[0-9]")
_RUN = re.compile("[0-9]+")
_SPELT = re.compile(r"[(\[](?:at|dot)[)\]]| at | dot ")
_NOT_WORD = re.compile("[^0-9a-z]+")

CHAIN_CHARS = 40            # mentions closer than this share a chain edge
SETTLED = 1e-6              # change of a message below which it has settled
DAMPING = (0.5, 0.8, 0.95)  # share of the old message in the new one
ROUNDS = 300                # with each damping, at most
CONFIDENCE = 0.8
SAME, NEXT = 6.0, 0.2       # log potentials of equal labels along skip and chain edges
DOUBT = 4.0                 # log odds that a shape alone can speak against a kind, at most
NEVER = -1e9                # log potential of what base spans rule out, whatever any number of messages say
SHAPES = 1 << 12


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_RUN.findall(s))


def well_formed(kind: str, s: str) -> bool:
    """The checks behind the base patterns."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(_digits(s)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: from each @, back to the start of its run and on over the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _addresses(text: str) -> Iterator[re.Match]:
    """Matches of ``_ADDRESS``: at the end of the last one, else at the start of a run."""
    end = 0
    while m := (end and _ADDRESS.match(text, end)) or _ADDRESS_RUN.search(text, end):
        yield m
        end = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then of starts."""
    out = []
    has_digit = _DIGIT.search(text) is not None
    for k, kind in enumerate(KINDS):
        if kind == "email":
            out += [(k, s, e) for s, e in _emails(text)]
        elif has_digit and (kind != "phone" or "+" in text):
            pattern = _IP if kind == "ip" else PATTERNS[kind]
            out += [(k, m.start(), m.end()) for m in pattern.finditer(text) if well_formed(kind, m.group())]
    return out


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) by start: base spans with their kind, other mentions with -1."""
    taken = sorted((s, e, k) for k, s, e in base)

    merged: list[tuple[int, int]] = []
    for s, e, _ in taken:
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    starts = [s for s, _ in merged]

    def free(s: int, e: int) -> bool:
        i = bisect_right(starts, e - 1) - 1
        return i < 0 or merged[i][1] <= s

    found = list(taken)
    if "@" in text or "at]" in text or "at)" in text or (" dot " in text and " at " in text):
        found += [(m.start(), m.end(), -1) for m in _addresses(text) if free(m.start(), m.end())]
    if _DIGIT.search(text) is not None:
        found += [(m.start(), m.end(), -1) for m in _NUMBER.finditer(text)
                  if free(m.start(), m.end()) and len(_digits(m.group())) >= 6]
    found.sort()
    out: list[tuple[int, int, int]] = []
    for s, e, k in found:       # an address before a number inside it
        if k < 0 and out and s < out[-1][1]:
            continue
        out.append((s, e, k))
    return out


def _shape(s: str) -> list[int]:
    """Hashed features of a mention's form."""
    digits = _digits(s)
    n = len(digits)
    marks = "".join(sorted({c for c in s if not c.isalnum()}))
    groups = ".".join(str(len(g)) for g in _RUN.findall(s))
    raw = (f"n{n}", f"m{marks}", f"g{groups}", f"l{16 <= n <= 19 and luhn(digits)}", f"a{any(c.isalpha() for c in s)}",
           f"o{s.count('.') == 3 and all(g.isdigit() and len(g) < 4 and int(g) < 256 for g in s.split('.'))}",
           f"p{s[:1] == '+'}")
    return [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=4).digest(), "big") % SHAPES for x in raw]


def _keys(s: str) -> list[str]:
    """Contents by which mentions are repeated or similar."""
    plain = _NOT_WORD.sub("", _SPELT.sub("", s.lower()))
    digits = _digits(s)
    keys = [f"w{plain}"] if plain else []
    if len(digits) >= 7 and not any(c.isalpha() for c in s):
        keys += [f"d{digits}", f"t{digits[-10:]}" if len(digits) >= 10 else f"t{digits}"]
    return keys


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (cls, bucket, n) of shapes by label; the last class is no kind. Bucket SHAPES counts mentions."""
    totals = np.zeros((len(KINDS) + 1, SHAPES + 1), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            for s, e, k in mentions(text, base_spans(text)):
                totals[k, SHAPES] += 1
                for x in _shape(text[s:e]):
                    totals[k, x] += 1
    cls, bucket = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cls, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[cls, bucket])], ["cls", "bucket", "n"])


def _beliefs(unary: np.ndarray, left: np.ndarray, right: np.ndarray, weight: np.ndarray,
             graph: np.ndarray | None = None) -> np.ndarray:
    """Loopy sum-product over nodes (n, labels) and edges with a log potential for equal labels.

    ``graph``: the graph of each edge; a graph's messages depend on its own only, and stay once all have settled.
    """
    labels = unary.shape[1]
    if graph is None:
        graph = np.zeros(len(left), np.int64)
    graphs = int(graph.max()) + 1 if len(graph) else 0
    source, target, graph = np.concatenate([left, right]), np.concatenate([right, left]), np.tile(graph, 2)
    back = np.concatenate([np.arange(len(left)) + len(left), np.arange(len(left))])
    same = np.exp(np.tile(weight, 2))[:, None]
    message = np.full((len(source), labels), 1.0 / labels)
    swings = np.ones(graphs, bool)

    def gathered() -> np.ndarray:
        total = unary.copy()
        np.add.at(total, target, np.log(message))
        return total

    for damping in DAMPING:
        for _ in range(ROUNDS):
            if not swings.any():
                break
            cavity = gathered()[source] - np.log(message[back])
            cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
            # sum over the sender's labels: one for different labels, e^weight for equal ones
            new = cavity.sum(axis=1, keepdims=True) + (same - 1.0) * cavity
            new /= new.sum(axis=1, keepdims=True)
            new = np.maximum(damping * message + (1.0 - damping) * new, 1e-12)
            change = np.zeros(graphs)
            np.maximum.at(change, graph, np.abs(new - message).max(axis=1))
            message = np.where(swings[graph][:, None], new, message)
            swings &= change > SETTLED * (1.0 - damping)
    total = gathered()
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _form(kind: str, s: str) -> bool:
    """What an added span of a kind has to look like at least."""
    n = len(_digits(s))
    return {"email": not s.replace(".", "").isdigit() and any(c.isalpha() for c in s), "ip": s.count(".") == 3 and n >= 4,
            "card": 12 <= n <= 19, "phone": 7 <= n <= 15}[kind]


def _alike(forms: list[str]) -> list[int]:
    """For every mention the first one that it shares its content with, by any chain of equal keys."""
    root = list(range(len(forms)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[str, int] = {}
    for i, form in enumerate(forms):
        for key in _keys(form):
            a, b = find(first.setdefault(key, i)), find(i)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(forms))]


def added_spans(texts: list[str], bases: list[list], model: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The field's spans (kind, start, end) of each text."""
    out: list[list] = [[] for _ in texts]
    nodes, unary, left, right, weight = [], [], [], [], []
    none = len(KINDS)
    for t, (text, base) in enumerate(zip(texts, bases)):
        own = mentions(text, base)
        if all(k >= 0 for _, _, k in own):
            continue                    # nothing to decide
        alike = _alike([text[s:e] for s, e, _ in own])
        size = Counter(alike)
        seen: dict[int, Counter] = {}
        for root, (_, _, k) in zip(alike, own):
            if k >= 0:
                seen.setdefault(root, Counter())[k] += 1
        hubs: dict[int, int] = {}
        before = None
        for root, (s, e, k) in zip(alike, own):
            if size[root] > 1 and root not in hubs:
                hubs[root] = len(nodes)
                nodes.append(None)
                kinds = seen.get(root)
                most = [x for x, n in kinds.items() if n == max(kinds.values())] if kinds else range(none + 1)
                unary.append(np.where(np.isin(np.arange(none + 1), most), 0.0, NEVER))
            here, form = len(nodes), text[s:e]
            nodes.append((t, s, e, k))
            # the features of a shape say much the same, so their mean counts
            score = (model[:, SHAPES] + model[:, _shape(form)].sum(axis=1)) / 8.0
            score = np.maximum(score, score.max() - DOUBT)
            if k >= 0:
                score = np.full(none + 1, NEVER)
                score[k] = 0.0
            elif root in hubs:          # a base span's kind is the hub's already
                left.append(hubs[root])
                right.append(here)
                weight.append(SAME)
            unary.append(score - score.max())
            if before is not None and s - before[1] <= CHAIN_CHARS and before[2] != root:
                left.append(before[0])
                right.append(here)
                weight.append(NEXT)
            before = (here, e, root)
    if not nodes:
        return out
    whose = np.array([nodes[r][0] for r in right], np.int64)
    p = _beliefs(np.array(unary), np.array(left, np.int64), np.array(right, np.int64), np.array(weight), whose)
    for node, belief in zip(nodes, p):
        if node is None:
            continue
        t, s, e, k = node
        best = int(np.argmax(belief))
        if k < 0 and best != none and belief[best] >= CONFIDENCE and _form(KINDS[best], texts[t][s:e]):
            out[t].append((best, s, e))
    return out


def _scan(late, keep: int) -> Callable:
    """The kept columns, base and added spans as lists of (kind, start, end)."""
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(keep).to_pylist()]
            bases = [base_spans(t) for t in texts]
            added = added_spans(texts, bases, late.value)
            as_rows = lambda spans: pa.array(
                [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], span)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], as_rows(bases), as_rows(added)],
                                             [*batch.schema.names[:keep], "base", "added"])
    return run


def fit_shapes(docs: DataFrame, *, text_col: str = "text") -> np.ndarray:
    """Log probabilities (labels, shapes and prior), counted over all documents."""
    prepare(docs.sparkSession)
    counts = np.zeros((len(KINDS) + 1, SHAPES + 1))
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _evidence, "cls int, bucket int, n long").groupBy("cls", "bucket").agg(F.sum("n").alias("n"))
    for r in rows.collect():            # at most labels * shapes rows
        counts[r["cls"], r["bucket"]] = r["n"]
    labels = counts[:, SHAPES] + 1.0
    model = np.log((counts + 0.1) / (labels[:, None] + 0.2))
    model[:, SHAPES] = np.log(labels / labels.sum())
    return model


def find_pii(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id) plus base and added: arrays of struct(kind, start, end)."""
    spark = prepare(docs.sparkSession)
    names = keep or ["doc_id"]
    late = spark.sparkContext.broadcast(fit_shapes(docs, text_col=text_col))
    sent = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("_text"))
    span = "array<struct<kind:int,start:int,end:int>>"
    return sent.mapInArrow(_scan(late, len(names)), schema_of(sent.schema.fields[:-1], f"base {span}, added {span}"))


def span_list(spans):
    """kind:start:end, by kind, then start, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text, spans):
    """``text`` with every span replaced by its kind in brackets; of overlapping ones the first, longest."""
    text = F.col(text) if isinstance(text, str) else text
    kind = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("neg_end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["start"] < a["at"], F.struct(
        F.greatest(a["at"], -s["neg_end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
            (-s["neg_end"]).alias("at"),
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(kind, s["kind"])).alias("out")))
    end = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(order, start, step, end)).otherwise(text)
