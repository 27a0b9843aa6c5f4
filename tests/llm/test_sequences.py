"""The prefix trie, periodic runs and BPE, against plain Python and the file's own library."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tally.llm import bpe, prefix_trie, queries
from tally.llm.runs import find_runs, periodic_runs

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "a", "A b", "é" * 300, "x " * 900, "a b " * 400, "it's " * 7 + "<|endoftext|>'ll 12½", "\x1c\x85　x"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- the trie

def plain_trie(turns):
    """Node rows of (conv_id, turn, role, text) rows, straight from the definition, after the query's rebuilding."""
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            own[c].append(((n is not None, n or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(rows, key=lambda x: x[0])] for c, rows in own.items()}
    nodes = defaultdict(list)
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = own.get(c - c % 20, [])[:h] + rows[h:]
        for d in range(len(rebuilt) + 1):
            nodes[tuple(rebuilt[:d])].append((c, d == len(rebuilt)))
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        saved = sum((len(nodes[p]) - 1) * len(re.findall("[^ \t-\r]+", p[-1][1])) for p in below if p)
        childless = [p for p in below if not any(q[:-1] == p for q in nodes if q)]
        ends = ",".join(map(str, sorted(c for c, end in members if end)))
        out.append((min(c for c, _ in members), len(path), min(c for c, _ in nodes[path[:-1]]) if path else None, len(members),
                    sum(1 for q in nodes if q and q[:-1] == path), len(childless), saved, sha(ends)))
    return sorted(out)


def trie(spark, turns):
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, depth string")
    rows = prefix_trie.prefix_trie(queries.rebuilt_conversations(prefix_trie.sequences(df)))
    return sorted(map(tuple, rows.collect()))


def conversations(seed):
    rng = random.Random(seed)
    turns = []
    for c in rng.sample(range(130), 70):
        turns += [(c, k, rng.choice(["user", "bot"]), f"{rng.choice('abc')} {rng.choice('xy')}\nsaid") for k in range(rng.randrange(0, 6))]
    copied = [("user", "hello there"), ("bot", "how are you"), ("user", "well")]
    for c in range(200, 230):           # a beginning that many share, some ending in it
        turns += [(c, k, *x) for k, x in enumerate(copied[:rng.randrange(1, 4)])]
    return turns + [(300, None, None, None), (300, 0, "user", ""), (300, None, None, None), (None, 0, "user", "lost"), (321, 5, "", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    if seed == 2:                       # every parent is found by broadcast
        monkeypatch.setattr(prefix_trie, "HOT_LEAST", 0)
    turns = conversations(seed)
    want = plain_trie(turns)
    assert trie(spark, turns) == want and len(want) > 50


def test_prefix_trie_of_one_and_of_none(spark):
    empty = sha("")
    assert trie(spark, []) == []
    assert trie(spark, [(1, 0, "user", "a b")]) in (
        [(1, 0, None, 1, 0, 1, 0, sha("1"))], [(1, 0, None, 1, 1, 1, 0, empty), (1, 1, 1, 1, 0, 1, 0, sha("1"))])


def test_prefix_trie_matches_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    got = queries.op11_prefix_trie(spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op11_prefix_trie']})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


# ---- periodic runs

def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if i > s and n >= max(6, 4 * q) and not any(w[s:s + n - p] == w[s + p:s + n] for p in range(1, q)):
                out.append((s, n, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts(seed):
    rng = random.Random(seed)
    texts = list(ODD)
    for _ in range(150):
        w = [rng.choice("abcde"[:rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randrange(1, 130))]
        if rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randrange(1, 20)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)) if i < a or a + (i - a) % p < len(w)]
            w = w[:rng.randrange(len(w))] + w + w
        texts.append(rng.choice([" ", "\n", " \t"]).join(w))
    return texts


def test_periodic_runs(spark, documents):
    texts = periodic_texts(4)
    got = {r["doc_id"]: r for r in periodic_runs(documents(list(enumerate(texts)))).collect()}
    count = 0
    for k, text in enumerate(texts):
        w = re.findall("[^ \t-\r]+", text or "")
        want = plain_runs(w)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert [tuple(r) for r in got[k]["runs"]] == want
        assert got[k]["collapsed"] == " ".join(x for i, x in enumerate(w) if i not in gone)
        count += len(want)
    assert count > 100
    with pytest.raises(ValueError):
        periodic_runs(documents([]), min_periods=3)
    assert periodic_runs(documents([])).count() == 0


def test_runs_of_very_long_texts():
    names = np.array([1] * 300_000 + [2, 3] * 200_000 + list(range(10, 100_010)), np.uint64)
    runs = find_runs(names, np.array([0, 0, len(names)]))
    assert [x.tolist() for x in runs] == [[0, 300_000], [300_000, 400_000], [1, 2]]


def test_digests_of_periodic_runs(spark, documents, tmp_path):
    rng = random.Random(9)
    texts = [*ODD, *[" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 400))) for _ in range(300)], "a\tb " * 9]
    documents([*enumerate(texts), (None, "b b b b b b b")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for k, text in enumerate(texts):
        w = re.findall("[^ \t-\r]+", text or "")
        n, h = len(w), zlib.crc32(str(k).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(w)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want = (k, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
        assert tuple(got[k]) == want
    assert planted > 10 and got[None]["n_runs"] == 1


# ---- BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(queries.word_bpe_path())
    own.no_truncation()
    own.no_padding()
    return own


def awkward_texts(seed):
    rng = random.Random(seed)
    marks = ["'s", "'ll", "'", "''ve", "’s", "é", "e\u0301", "İ", "ΑΣ", "ß", "ﬁ", "½", "12", "日本", "\u200d", "👍🏽", "<|endoftext|>", "<|startoftext|>",
             "<|", " ", "\n", "\x85", "\x1c", "the", "Running", "Ⅷ", "\U00016ea0", "!!!", "aaaa"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(300, 4000))) for letters in ("aab", "aethinsrol", "!?", "é") for _ in range(5)]
    return [*ODD, *texts, "a" * 5001, "ab" * 9000, "word " * 20_000]


def test_bpe_equals_the_library(spark, documents, library):
    texts = awkward_texts(6)
    path = queries.word_bpe_path()
    rows = bpe.decode(bpe.encode(documents(list(enumerate(texts))), path), path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_bpe_of_given_documents(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op13_word_bpe(spark, SF).collect():
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert tuple(r)[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_bpe_of_every_character(library):
    encoder = bpe.Encoder(bpe.Merges(queries.word_bpe_path()))
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 8000):
        texts = [f"a{chr(c)}B{chr(c)}{chr(c)} '{chr(c)}" for c in points[low:low + 8000]]
        ids, at = encoder.encode(texts)
        for k, x in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert x.ids == ids[at[k]:at[k + 1]].tolist(), texts[k]


def test_a_worker_forgets_words_beyond_its_bound(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 50)
    encoder = bpe.Encoder(bpe.Merges(queries.word_bpe_path()))
    rng = random.Random(2)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(400)}x" for _ in range(40))]
        assert encoder.encode(texts)[0].tolist() == library.encode(texts[0], add_special_tokens=False).ids
    assert len(encoder.names) < 400


def test_decoding_skips_what_the_vocabulary_lacks(spark):
    rows = spark.createDataFrame([(1, [320, None, -5, 10 ** 9, 49407]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, queries.word_bpe_path()).collect()}
    assert got == {1: "a</w> <|endoftext|>", 2: "", 3: ""}


def test_a_vocabulary_without_word_ends_is_refused():
    with pytest.raises(ValueError):
        bpe.Merges(queries.tokenizer_path())
