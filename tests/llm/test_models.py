"""Fitted operators on the given tables (held-out figures) and on awkward rows; revisits; the pipeline."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tally.llm import queries
from tally.llm.importance import resample
from tally.llm.mixing import mix
from tally.llm.revisits import resolve_revisits
from tally.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "clown " * 300), (None, "no id"), (5, "é!?" * 2000)]
LABELS = "doc_id long, quality int, toxic int"


def test_importance_keeps_good_and_rejects_bad(spark):
    rows = queries.op1_importance_resampling(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    assert len(rows) == 1000
    assert both[both.quality == 1].kept.mean() > 0.9
    assert both[both.quality == 0].kept.mean() < 0.2


def test_toxicity_on_held_out_rows(spark):
    rows = queries.op4_toxicity(spark, SF).toPandas()
    both = rows.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    bad, good = held[held.toxic == 1].score, held[held.toxic == 0].score
    auc = sum((bad.values > g).sum() + 0.5 * (bad.values == g).sum() for g in good) / (len(bad) * len(good))
    assert auc > 0.7 and rows.score.between(0, 1).all()


def test_mixing_meets_the_targets(spark):
    rows = queries.op9_source_mixing(spark, SF).toPandas()
    total = rows.n_tokens.sum()
    for domain, weight in queries.DOMAIN_WEIGHTS.items():
        assert abs((rows.rate * rows.n_tokens * rows[f"p_{domain}"]).sum() / total - weight) < 1e-5
    assert (rows.rate >= 0).all()


@pytest.mark.parametrize("seed", range(6))
def test_rates_are_the_nearest_to_one_that_meet_the_targets(spark, seed):
    """Rare domains, rates at zero and a domain that nothing belongs to, against a plain descent on the objective."""
    from tally.llm.mixing import fit_gradient
    rng = np.random.default_rng(seed)
    n, classes = 400, int(rng.integers(2, 6))
    p = rng.dirichlet(np.where(np.arange(classes) == 0, 1.0, 0.08), n)
    if seed % 2:
        p[:, -1] = 0.0
        p /= p.sum(axis=1, keepdims=True)
    tokens = rng.integers(0, 500, n)
    weights = (rng.exponential(1.0, n) * tokens) @ p        # targets that some rates meet, but for the last domain
    weights /= weights.sum()
    if seed % 2:
        weights = 0.9 * weights + 0.1 * (np.arange(classes) == classes - 1)
    rows = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "n_tokens long, posterior array<double>")
    ridge = 1e-7 if seed < 4 else 0.05
    g = fit_gradient(rows.repartition(3), weights, ridge=ridge)
    rate = np.maximum(0.0, 1.0 - p @ g)
    gap = (rate * tokens) @ p / tokens.sum() - weights
    if ridge < 1e-3:
        assert np.abs(gap[p.any(axis=0)]).max() < 1e-4

    def objective(r):
        away = (r * tokens) @ p / tokens.sum() - weights
        return away @ away / 2 + ridge / 2 * (tokens * (r - 1) ** 2).sum() / tokens.sum()
    best = objective(rate)
    for _ in range(300):                # no other rates are better
        other = np.maximum(0.0, rate + rng.normal(0, 10.0 ** -rng.integers(1, 6), n) * (rng.random(n) < 0.1))
        assert objective(other) >= best - 1e-12


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(3, 1, 1), (3, 1, 1), (4, 0, 0), (None, 1, None), (5, None, 0)]])
def test_awkward_rows(spark, documents, labels):
    docs, known = documents(ODD), spark.createDataFrame(labels, LABELS)
    assert resample(docs, known).count() == len(ODD)
    scores = toxicity_scores(docs, known).toPandas().score
    assert len(scores) == len(ODD) and scores.between(0, 1).all()
    rates = mix(docs, queries.labelled_domains(known), {"clean": 0.9, "low": 0.1}).toPandas()
    assert len(rates) == len(ODD) and (rates.rate >= 0).all()
    empty = documents([])
    assert resample(empty, known).count() == toxicity_scores(empty, known).count() == 0
    assert mix(empty, queries.labelled_domains(known), {"clean": 1.0}).count() == 0


def test_lexicon_counts_every_different_text(spark, documents):
    from tally.llm.toxicity import character_model, fit_lexicon
    common = " ".join(f"common{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20))    # holds the least hash of all
    rows = [(i, f"{common} {'zorgle' if i < 12 else 'gentle'} x{i}") for i in range(60)]
    rows += [(100 + i, f"{common}  ONCE{' ' * i} said") for i in range(12)]                         # one text, copied
    labels = spark.createDataFrame([(d, 1, int(d < 12 or d >= 100)) for d, _ in rows], LABELS)
    docs = documents(rows)
    lexicon, floor = fit_lexicon(docs, labels, character_model(docs))
    assert "zorgle$" in lexicon and "gentle$" not in lexicon and "once$" not in lexicon
    assert floor == (13 / 61) ** 2


def test_restoring_words(spark, documents):
    from tally.llm.toxicity import Restorer, character_model
    model = character_model(documents([(i, "the moron and the idiot said stupid things about pathetic scum") for i in range(50)]))
    words = Restorer(model).words("m0r0n i d i o t stuuuupid p@thetic s-c-u-m")
    assert {"moron", "idiot", "stupid", "pathetic", "scum"} <= words


@pytest.mark.parametrize("text, words", [
    ("such a m o r o n", {"such", "moron"}), ("s t u p i d i d i o t", {"stupid", "idiot"}), ("455 he @55", {"ass"}),
    ("$#!7", {"shit"}), ("@$$ (a$$)", {"ass"}), ("m" + "0" * 70 + "ron", {"moron"}),
    ("you_are_such_a_m0r0n_" * 5, {"you", "moron"}), ("said.stuff.about.the.p@thetic.1d10t.and.all.of.the.others.too", {"pathetic", "idiot"})])
def test_restoring_every_token(spark, documents, text, words):
    from tally.llm.toxicity import Restorer, character_model
    said = "you are such a moron and the idiot said stupid stuff about pathetic scum like shit and all of the others too ass"
    assert words <= Restorer(character_model(documents([(i, said) for i in range(50)]))).words(text)


def test_revisits_match_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = queries.op7_revisits(spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op7_revisits']})").fetchall()
    plain = lambda r: tuple(map(str, r))
    assert sorted(map(plain, got.collect())) == sorted(map(plain, want))


def test_revisit_rules(spark):
    headers = "array<struct<name:string,value:string>>"
    tag = lambda v: [("ETag", v)]
    full = spark.createDataFrame(
        [("a", "http://X.org/p/", 100, [("ETag", 'W/"1"'), ("Vary", "a")], "d1", 5),
         ("b", "https://www.x.org:443/p#f", 9000, tag('"2"'), "d2", 6), ("c", None, 1, None, "d3", 7)],
        f"record_id string, url string, ts long, headers {headers}, payload_digest string, payload_bytes long")
    asks = spark.createDataFrame(
        [("early", "x.org/p", 100, tag('"1"')), ("one", "x.org/p", 101, [*tag('"1"'), ("Vary", "b"), ("Server", "s")]),
         ("slices", "x.org/p?utm_a=1", 8000, tag('"1"')), ("stale", "x.org/p", 9001, tag('"1"')),
         ("bare", "x.org/p", 9001, None), ("none", "x.org/q", 9001, tag('"1"')), ("null", None, None, None)],
        f"record_id string, url string, ts long, headers {headers}")
    got = {r["record_id"]: r for r in resolve_revisits(full, asks).collect()}
    status = {k: (r["status"], r["response_id"]) for k, r in got.items()}
    assert status == {"early": ("no_response", None), "one": ("resolved", "a"), "slices": ("resolved", "a"),
                      "stale": ("validator_mismatch", "b"), "bare": ("no_validator", "b"), "none": ("no_response", None),
                      "null": ("no_response", None)}
    assert [tuple(h) for h in got["one"]["headers"]] == [("etag", '"1"'), ("vary", "b")]
    assert got["one"]["payload_digest"] == "d1" and got["stale"]["payload_digest"] is None
    assert resolve_revisits(full.limit(0), asks.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5
    seen = docs
    for name, stage in P.STAGES[:-1]:
        before, seen = seen, P.saved(stage(spark, seen, SF), "test-stage")
        assert seen.columns == docs.columns
        assert 0 < seen.count() <= before.count()

        if name == names[2]:
            assert P.benchmark_hits(seen, queries.table(spark, SF, "benchmark")).where("n_hit > 0").isEmpty()
        if name == names[3]:
            assert P.find_pii(seen).where("size(base) > 0").isEmpty()
    last = P.STAGES[-1][1](spark, seen, SF)
    assert last.count() == seen.count() and set(P.run(spark, SF).columns) == set(last.columns)


def test_pipeline_on_awkward_rows(spark, documents, tmp_path):
    import corpus_pipeline as P
    spark.createDataFrame([(3, 1, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (ODD, []):
        docs = documents(rows)
        for _, stage in P.STAGES:
            docs = P.saved(stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.count() <= len(rows)


def test_near_duplicates_keeps_one_row_of_each_group(spark, tmp_path):
    import random

    import corpus_pipeline as P
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    a, b = text(120), text(120)
    near = b.replace(b.split()[60], "changed", 1)
    rows = [(1, a), (2, a), (2, b), (None, near), (None, near), (7, ""), (7, ""), (8, None), (9, "one two"), (9, "one two"), (10, "two one")]
    for k in range(20, 60):             # ids of several texts, copies and near copies across ids
        own = text(rng.randrange(30, 90))
        rows += [(k, own), (rng.randrange(20, 60), own), (rng.choice([None, k, k + 1]), own.replace(own.split()[3], "x", 1))]
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(d, t, str(i)) for i, (d, t) in enumerate(rows)], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = P.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert kept.columns == docs.columns
    kept = kept.collect()
    sets = [frozenset(zip(*(t.split()[i:] for i in range(5)))) if t and len(t.split()) >= 5 else frozenset([tuple(t.split())] if t else [])
            for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), set()).add(i)
    got = [int(r["lang"]) for r in kept]
    assert len(got) == len(set(got)) == len(groups)
    for members in groups.values():
        (one,) = members & set(got)
        assert rows[one][0] == min((rows[m][0] for m in members), key=lambda d: (d is None, d or 0))


def test_quality_limits_from_exact_quantiles(spark):
    """Limits and verdicts on the given tables, restated with exact quantiles (the sketches err by under 1 %)."""
    from tally.llm import quality_rules as Q
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = Q.base_measures(docs).drop("text")
    rows = rows.withColumns({m: F.col(n) / F.greatest(F.col(d), F.lit(1)) for m, (n, d, *_) in Q.MEASURES.items()})
    got = {(r["lang"], r["source"]): r for r in Q.limits(rows).collect()}
    table = rows.select("lang", "source", *Q.MEASURES).toPandas()

    def fence(part, m):
        *_, tail, wide, low = Q.MEASURES[m]
        at = lambda v, q: np.sort(v)[max(0, int(np.ceil(q * len(v) - 1e-9)) - 1)]
        v = part[m].to_numpy()
        below, middle, top = (at(v, q) for q in (1 - tail, 0.5, tail))
        spread = top - middle
        if not low and (v > 0).any():
            spread = max(spread, at(v[v > 0], 0.5) * (v > 0).mean())
        return (middle - wide * (middle - below) if low else -np.inf), middle + wide * spread
    blend = lambda x, n, y: x if np.isinf(x) else (n * x + Q.BLEND * y) / (n + Q.BLEND)
    for m in Q.MEASURES:
        whole, seen = fence(table, m), set()
        for lang, inner in table.groupby("lang"):
            middle = [blend(x, len(inner), y) for x, y in zip(fence(inner, m), whole)]
            for source, own in inner.groupby("source"):
                want = [blend(x, len(own), y) for x, y in zip(fence(own, m), middle)]
                row = got[lang, source]
                seen.add(round(row[f"hi_{m}"], 9))
                for side, x in zip(("lo", "hi"), want):
                    assert row[f"{side}_{m}"] == x or abs(row[f"{side}_{m}"] - x) < 0.02 + 0.05 * abs(x), (m, lang, source)
        assert len(seen) > 20 and min(seen) > 0        # limits differ between groups, and none is zero
