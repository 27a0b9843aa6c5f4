"""Operators with an exact result, against plain Python on texts made to be awkward."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tally.llm import jaccard_join, queries, suffix_dedup
from tally.llm.decontaminate import benchmark_hits, items_digest
from tally.llm.jaccard_join import jaccard_components
from tally.llm.pii import base_spans, find_pii, masked, span_list
from tally.llm.quality_rules import judge
from tally.llm.select import kth_largest
from tally.llm.suffix_dedup import remove_repeats
from tally.llm.textbytes import LOWER, SPACE, blocks, shingles
from tally.llm.token_counts import token_counts
from tally.operators.keyfilter import cannot_match, key_filter, may_match

ODD = [None, "", " \n\t", "a", "A b", "é" * 300, "ab" * 400, "x " * 900, "THE!! the!! THE!!\n" * 40]


def words_of(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    texts = list(ODD)
    base = [words_of(rng, rng.randrange(30, 400)) for _ in range(12)]
    shared = words_of(rng, 130)
    for text in base:
        texts += [text, text]
        own = text.split()
        for _ in range(3):
            copy = own.copy()
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += [f"{words_of(rng, 20)} {shared} {words_of(rng, 25)}" for _ in range(8)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[-1], (rows[-2][0], "another text of the same id")]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, documents, seed):
    rows, length = corpus(seed), 400
    data = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(x[i:i + length] for _, x in data for i in range(len(x) - length + 1))
    want = []
    for d, x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if count[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        want.append((d, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = remove_repeats(documents(rows), length=length).collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(w[2] for w in want)


def test_repeats_beyond_the_broadcast(spark, documents, monkeypatch):
    docs = documents(corpus(3))
    few = sorted(map(tuple, remove_repeats(docs, with_text=True).collect()))
    monkeypatch.setattr(suffix_dedup, "BROADCAST_RUNS", 0)
    assert sorted(map(tuple, remove_repeats(docs, with_text=True).collect())) == few and any(r[2] for r in few)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_texts_without_runs_are_not_shuffled(spark, monkeypatch, how):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_RUNS", 0)
    texts = spark.range(400).select("id", F.xxhash64("id").alias("name"), F.col("id").cast("string").alias("text"))
    lists = texts.where("id % 100 = 7").select("id", "name", F.array(F.struct(F.col("id").alias("at"))).alias("runs"))
    found = suffix_dedup._joined(texts, lists, "runs", how)
    assert "getbit" in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r.runs for r in found.collect()}
    assert sorted(k for k, v in got.items() if v) == [7, 107, 207, 307] and len(got) == (4 if how == "inner" else 400)


def test_a_key_filter_parts_the_rows(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("key"))
    wanted = key_filter(rows.where("key % 10 = 3"), "key")
    match, rest = (sorted(r.key or 0 for r in f(rows, "key", wanted).collect()) for f in (may_match, cannot_match))
    assert set(range(3, 1000, 10)) <= set(match) and len(match) < 110
    assert sorted(match + rest) == sorted(r.key or 0 for r in rows.collect()) and rest[:20] == [0] * 20


def shingle_set(text, size):
    w = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(w[i:] for i in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 50)])
def test_jaccard_components(spark, documents, size, percent):
    rows = corpus(percent)
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    want = sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))
    got = jaccard_components(documents(rows), size=size, percent=percent).collect()
    assert sorted(map(tuple, got)) == want


def test_a_chain_of_near_copies_is_one_component(spark, documents):
    own = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(150):            # each changes one more word; ends are far from each other
        own[(7 * k) % 200] = f"new{k}"
        rows.append((k, " ".join(own)))
    got = jaccard_components(documents(rows)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_frequency_levels_count_all_documents(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FAN_IN", 2)      # several rounds of adding
    rows = corpus(3) + [(1000 + i, f"common words here w{i} x{i}") for i in range(700)] + [(None, None), (1, "")]
    texts = documents(rows).select("text").repartition(9)
    got = jaccard_join.frequency_levels(texts, 3)
    count = Counter()
    for _, t in rows:
        column = pa.array([t or ""])
        for block in blocks(column):
            _, _, names, at = block.words(~SPACE, LOWER)
            count.update((shingles(names, at[0], at[1], 3) % jaccard_join.COUNTERS).tolist())
    want = np.zeros(jaccard_join.COUNTERS, np.uint8)
    for k, n in count.items():
        want[k] = min(255, round(7 * math.log2(n + 1)))
    assert max(count.values()) >= 700 and (got == want).all()
    assert not jaccard_join.frequency_levels(texts.limit(0), 3).any()


def test_shingles_of_few_documents_make_no_candidates(spark, documents):
    """A passage in a share of 0.3 % of the texts, ordered behind the rarer shingles of each, joins none of them."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, words_of(rng, 60, 10**9) + (" " + passage if i % 300 == 0 else "")) for i in range(6000)]
    levels = jaccard_join.frequency_levels(documents(rows).select("text"), 3)
    _, _, names, at = (block := next(blocks(pa.array([passage])))).words(~SPACE, LOWER)
    common = set(shingles(names, at[0], at[1], 3).view(np.int64).tolist())
    sets = jaccard_join._sets(3, 90, 8, spark.sparkContext.broadcast(levels))
    batch = documents(rows[::300]).select("doc_id", "text").toArrow().to_batches()
    prefixes = [set(p) for out in sets(iter(batch)) for p in out.column("prefix").to_pylist()]
    assert len(prefixes) == 20 and len(block) == 1
    assert not any(p & common for p in prefixes)


def test_benchmark_windows(spark, documents):
    rng = random.Random(5)
    items = [(i, words_of(rng, n, 60)) for i, n in enumerate([3, 10, 25, 40, 1, 9])] + [(6, None), (7, "!!"), (None, "w1 w2")]
    rows = corpus(7)
    for k, (_, t) in enumerate(items[:6]):
        own = t.split()
        rows.append((1000 + k, f"Some {t.upper()}, more"))
        rows.append((2000 + k, " ".join(own[:9]) + " other " + " ".join(own[9:])))
    table = spark.createDataFrame(items, "item_id long, text string")
    find = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = find(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    want = []
    for d, t in rows:
        w, hit, own = find(t), set(), set()
        for x, ids in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k:k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    own |= ids
        want.append((d, len(w), len(hit), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()))
    for part in (500_000, 20):      # one part, and several
        got = benchmark_hits(documents(rows), table, part=part).select(
            "doc_id", "n_words", "n_hit", items_digest("items")).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_base_measures(spark, documents):
    rows = corpus(11)

    def measure(t):
        w = re.findall("[^ \t-\r]+", t or "")
        grams = list(zip(w, w[1:], w[2:]))
        count = Counter(grams)
        cover = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (t or "").split("\n") if re.search("[^ \t-\r]", x)]
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover))
    got = judge(documents(rows)).collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted((d, *measure(t)) for d, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_limits_follow_the_rows(spark):
    rng = random.Random(17)

    def text(dup=0, symbols=0, lengths=(4, 5, 6)):
        lines = [[rng.choice("abcdefghijklmnop") + f"{rng.randrange(10 ** 9):09}"[:rng.choice(lengths) - 1] for _ in range(10)]
                 for _ in range(25)]
        for k in range(dup):
            lines[2 * k + 1] = lines[2 * k]
        for k in range(symbols):
            lines[k % 25][k // 25] = "#" + lines[k % 25][k // 25][1:]
        return "\n".join(" ".join(x) for x in lines)
    rows = [(i, text(), "de", "plain") for i in range(200)]
    rows += [(1000 + i, text(dup=rng.choice([0, 2, 4])), "de", "lists") for i in range(200)]     # where copied lines are usual
    odd = {"lines": text(dup=4), "symbols": text(symbols=50), "length": text(lengths=(6, 6, 6, 6, 7)), "one": f"so on\nso on\n{text()}",
           "sign": text(symbols=1)}
    rows += [(2000 + i, t, "de", "plain") for i, t in enumerate(odd.values())]
    rows += [(3000, odd["lines"], "de", "lists"), (3001, odd["symbols"], "de", "lists")]
    kept = {r["doc_id"]: r["kept"] for r in judge(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [kept[2000 + i] for i in range(5)] == [False, False, False, True, True]
    assert kept[3000] and not kept[3001]
    assert all(kept[i] and kept[1000 + i] for i in range(200))


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    rows = corpus(13) + [(9000, "it's <|endoftext|> they'll go  \n\n 12½ x² 日本語 ’s"), (9001, "<|endoftext|>" * 3)]
    want = sorted((d, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    assert sorted(map(tuple, token_counts(documents(rows), path).collect())) == want


def test_personal_data(spark, documents):
    text = ("mail a.b@c.org or A.B (at) c (dot) org, call +1 (504) 555-2652, again (504) 555-2652; "
            "ip 10.0.0.256 and 10.0.0.25, card 4539 1488 0343 6467, not 4539148803436468")
    many = [(i, f"Write to user{i}@mail{i % 3}.example.com or +1 (555) 555-{1000 + i} or 10.1.2.{i}") for i in range(60)]
    rows = [*many, (100, text), (101, text), *[(200 + i, t) for i, t in enumerate(ODD)]]
    got = {}
    for r in find_pii(documents(rows), keep=["doc_id", "text"]).select(
            "doc_id", span_list("base").alias("base"), span_list("added").alias("added"),
            masked("text", "base").alias("masked")).collect():
        got[r["doc_id"]] = r
    kinds = [s.split(":")[0] for s in got[100]["base"].split(",")]
    assert kinds == ["email", "ip", "card", "phone"]
    added = {text[int(a):int(b)] for _, a, b in (s.split(":") for s in got[100]["added"].split(",") if s)}
    assert "(504) 555-2652" in added
    assert got[101]["added"] == got[100]["added"]
    assert "[EMAIL]" in got[100]["masked"] and "10.0.0.25," not in got[100]["masked"]
    assert all(got[200 + i]["base"] == "" and got[200 + i]["added"] == "" for i in range(len(ODD)))
    assert got[200]["masked"] is None and base_spans("") == []


def test_base_spans_equal_the_plain_patterns():
    from tally.llm import pii
    rng = random.Random(5)
    marks = ["a", "B.", "@", "@", "c-d", ".", "1", "22", ".3", "+", " ", "-", "(", ")", "at", " at ", " dot ", "(dot)", "[at]", "%", "_",
             "4539148803436467", "10.0.0.1", "\n", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(1, 40)))
        assert base_spans(text) == [(k, m.start(), m.end()) for k, kind in enumerate(pii.KINDS)
                                    for m in pii.PATTERNS[kind].finditer(text) if pii.well_formed(kind, m.group())]
        assert [m.span() for m in pii._addresses(text)] == [m.span() for m in pii._ADDRESS.finditer(text)]


@pytest.mark.parametrize("text", ["7" * 1_000_000, "a" * 500_000 + "@" + "b" * 500_000, "a@" * 300_000, "1." * 300_000, "+1 " * 200_000])
def test_long_runs_take_time_in_proportion(text):
    import time

    from tally.llm import pii
    begin = time.process_time()
    pii.mentions(text, base_spans(text))
    assert time.process_time() - begin < 30


def test_messages_end_on_any_graph():
    from tally.llm.pii import _beliefs
    graphs = []
    for seed in range(300):
        rng = np.random.default_rng(seed)
        n, e = rng.integers(2, 12), rng.integers(1, 25)
        left, right = rng.integers(0, n, e), rng.integers(0, n, e)
        ok = left != right
        graphs.append((rng.normal(0, 4, (n, 5)), left[ok], right[ok], rng.choice([6.0, 0.2, -4.0], ok.sum())))
    alone = [_beliefs(*g) for g in graphs]
    assert all(np.allclose(p.sum(axis=1), 1.0) for p in alone)
    at = np.cumsum([0, *[len(g[0]) for g in graphs]])           # one graph's beliefs don't depend on the others
    together = _beliefs(np.concatenate([g[0] for g in graphs]), *[np.concatenate([g[k] + a for g, a in zip(graphs, at)]) for k in (1, 2)],
                        np.concatenate([g[3] for g in graphs]), np.repeat(np.arange(len(graphs)), [len(g[1]) for g in graphs]))
    assert all(np.allclose(p, together[a:a + len(p)], atol=1e-12) for p, a in zip(alone, at))


def test_one_label_for_far_repeats(spark, documents):
    far = " ".join(["and then they wrote about something else"] * 20)
    call, mail = "(504) 555-2652", "a.b (at) c (dot) org"
    text = f"call +1 {call} {far} " + f" {far} ".join([call] * 10) + f" {far} a.b@c.org {far} " + f" {far} ".join([mail] * 300)
    many = [(i, f"Write to user{i}@mail{i % 3}.example.com or +1 (555) 555-{1000 + i} or 10.1.2.{i}") for i in range(60)]
    many += [(100 + i, f"part ({100 + i}) 555-{2000 + i}, " * 3) for i in range(60)]       # shapes against a phone
    row = find_pii(documents([*many, (1000, text)])).where("doc_id = 1000").select(span_list("added").alias("added")).first()
    found = [(kind, text[int(a):int(b)]) for kind, a, b in (s.split(":") for s in row["added"].split(","))]
    assert found == [("email", mail)] * 300 + [("phone", call)] * 10


def test_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.gauss(0, 1), 0.5, 1e300, -1e-300]) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(4)
    order = sorted(values, reverse=True)
    for k in (1, 2, 777, 10_000, 20_000, 30_000):
        assert kth_largest(df, "x", k) == order[min(k, len(order)) - 1]
    assert kth_largest(df, "x", 0) is None


def test_empty_tables(spark, documents):
    empty = documents([])
    items = spark.createDataFrame([], "item_id long, text string")
    frames = [remove_repeats(empty), jaccard_components(empty), benchmark_hits(empty, items), judge(empty), find_pii(empty),
              token_counts(empty, queries.tokenizer_path()), benchmark_hits(documents([(1, None)]), items).where("n_hit > 0")]
    assert all(f.count() == 0 for f in frames)
