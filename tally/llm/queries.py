"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import bpe, prefix_trie
from tally.llm.decontaminate import benchmark_hits, items_digest
from tally.llm.importance import resample
from tally.llm.jaccard_join import jaccard_components
from tally.llm.mixing import mix
from tally.llm.pii import KINDS, find_pii, span_list
from tally.llm.quality_rules import judge
from tally.llm.revisits import resolve_revisits
from tally.llm.runs import periodic_runs
from tally.llm.store import prepare
from tally.llm.suffix_dedup import remove_repeats
from tally.llm.token_counts import token_counts
from tally.llm.toxicity import toxicity_scores

#: Documents scoring this or more are toxic.
TOXIC_FROM = 0.3

#: Longest document, in tokens, that a training sequence holds.
TOKEN_LIMIT = 512
#: Target weights of the domains that the labels tell apart.
DOMAIN_WEIGHTS = {"clean": 0.90, "toxic": 0.06, "low": 0.04}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (the folder can be in any store)."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, Gumbel key and verdict of every document; target: quality 1."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside 400-byte strings that start elsewhere too."""
    return remove_repeats(table(spark, sf_dir, "documents"), length=400)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every document."""
    rows = find_pii(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                       F.sha2(span_list("base").cast("binary"), 256).alias("base_sha256"),
                       span_list(F.concat("base", "added")).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the ids is held out from learning."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learn = table(spark, sf_dir, "labels").where(~held_out)
    rows = toxicity_scores(table(spark, sf_dir, "documents"), learn)
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside ten-word windows of benchmark items."""
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       items_digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of the adaptive rules for every document."""
    return judge(table(spark, sf_dir, "documents"))


def page_captures(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits) of a crawl derived from ``pages``.

    Every page is a response, a minute after the one before; every page is also
    revisited up to two days later by another spelling of its URL, one in
    eleven before its response. The revisit's validators are the page's, but
    for stale or missing ones at one page in five, seven and thirteen.
    """
    at = F.col("page_id") * 60 + 1_600_000_000
    field = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    digest = F.md5(F.col("html").cast("binary"))
    every = lambda n: F.col("page_id") % n == 0
    responses = pages.select(
        F.concat(F.lit("r"), "page_id").alias("record_id"), "url", at.alias("ts"),
        F.array(field("Content-Type", F.lit("text/html")), field("Content-Length", F.octet_length("html")),
                field("ETag", F.concat(F.lit('W/"'), digest, F.lit('"'))), field("Last-Modified", at - 86400),
                field("Cache-Control", F.lit("max-age=60")), field("Date", at)).alias("headers"),
        digest.alias("payload_digest"), F.octet_length("html").cast("long").alias("payload_bytes"))
    late = F.when(every(11), at - 30).otherwise(at + 3600 * (1 + F.col("page_id") % 48))
    tag = F.when(every(7), F.lit(None)).when(every(5), F.md5(F.col("page_id").cast("string").cast("binary"))).otherwise(digest)
    changed = F.when(every(13), F.lit(None)).otherwise(at - 86400)
    fields = F.array(field("Content-Type", F.lit("text/plain")), field("Content-Length", F.lit(0)),
                     field("ETag", F.concat(F.lit('"'), tag, F.lit('"'))), field("Last-Modified", changed),
                     field("Cache-Control", F.lit("max-age=3600")), field("Date", late), field("Expires", late + 3600))
    revisits = pages.select(
        F.concat(F.lit("v"), "page_id").alias("record_id"),
        F.concat(F.regexp_replace(F.regexp_replace("url", r"^https?://(www\.)?", "HTTPS://WWW."), "#.*$", ""), F.lit("#again")).alias("url"),
        late.alias("ts"), F.filter(fields, lambda h: h["value"].isNotNull()).alias("headers"))
    return responses, revisits


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the crawl derived from ``pages``, resolved; headers as name=value lines.

    ``payload_bytes`` is null where nothing was resolved and so a double, which both engines hand to pandas alike.
    """
    rows = resolve_revisits(*page_captures(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat(F.lower(h["name"]), F.lit("="), h["value"]))
    return rows.select("record_id", "url_key", "response_id", "status", F.array_join(lines, "\n").alias("headers"),
                       "payload_digest", F.col("payload_bytes").cast("double").alias("payload_bytes"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9: the component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: low quality, else toxic, else clean."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic")
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and rate of every document, for DOMAIN_WEIGHTS."""
    rows = mix(table(spark, sf_dir, "documents"), labelled_domains(table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS)
    return rows.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(DOMAIN_WEIGHTS)],
                       "rate")


def tokenizer_path() -> str:
    """Path of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counted = token_counts(table(spark, sf_dir, "documents"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def rebuilt_conversations(sequences: DataFrame) -> DataFrame:
    """Every conversation with the beginning of the first one of its twenty: (conv_id, turns).

    The first h turns are those of conversation conv_id - conv_id % 20 (as many as it has), the others its own
    after its first h; h is the remainder of a hash of the id.
    """
    base = F.col("conv_id") - F.col("conv_id") % 20
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = sequences.where(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("_head"))
    rows = sequences.withColumn("_h", h).join(heads, base == F.col("_base"), "left")
    head = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    return rows.select("conv_id", F.concat(head, F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations, a row per node."""
    return prefix_trie.prefix_trie(rebuilt_conversations(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by a hash of its id, made periodic from some word on, words joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words).alias("_words"))
    n = F.size("_words")
    rows = rows.select("*", F.when(n > 0, F.col("_g") % n).cast("int").alias("_from"), n.alias("_n"))
    left = F.col("_n") - F.col("_from")
    rows = rows.withColumn("_period", (1 + F.floor(left / (3 + F.col("_g") % 8))).cast("int"))
    piece = F.slice("_words", F.col("_from") + 1, F.col("_period"))
    again = F.slice(F.flatten(F.array_repeat(piece, F.ceil(left / F.col("_period")).cast("int"))), F.lit(1), left)
    periodic = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_from")), again), " ")
    return rows.select("doc_id", F.when(F.col("_from").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest periodic run of words of every document, and digests of all runs and of the collapsed text."""
    rows = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    longest = rows.withColumn("_longest", F.array_max(order))
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"), (-F.col("_longest.period")).alias("period"),
        F.expr("(1000 * _longest.length) div (-_longest.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def word_bpe_path() -> str:
    """Path of the public BPE vocabulary with word ends."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to, as digests."""
    path = word_bpe_path()
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_revisits": op7_revisits,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_word_bpe": op13_word_bpe,
}

#: DuckDB SQL where it can state a query.
ORACLE_SQL: dict[str, str] = {"op7_revisits": r"""
WITH captured AS (
  SELECT *, 1600000000 + page_id * 60 AS seen, md5(html) AS digest,
         regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://', '') AS bare
  FROM pages
), keyed AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', '') AS host,
         regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         regexp_replace(regexp_replace(regexp_extract(bare, '\?(.*)$', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
  FROM captured
), records AS (
  SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key,
         CASE WHEN page_id % 11 = 0 THEN seen - 30 ELSE seen + 3600 * (1 + page_id % 48) END AS late,
         CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN md5(page_id::VARCHAR) ELSE digest END AS tag,
         CASE WHEN page_id % 13 = 0 THEN NULL ELSE seen - 86400 END AS changed
  FROM keyed
), matched AS (
  SELECT v.page_id, v.url_key, v.late, v.tag, v.changed, r.page_id AS of_id, r.seen AS of_seen, r.digest AS of_digest,
         strlen(r.html) AS of_bytes
  FROM records v ASOF LEFT JOIN records r ON v.url_key = r.url_key AND v.late > r.seen
), judged AS (
  SELECT *, CASE WHEN of_id IS NULL THEN 'no_response'
                 WHEN tag IS NULL AND changed IS NULL THEN 'no_validator'
                 WHEN COALESCE(tag = of_digest, changed = of_seen - 86400) THEN 'resolved'
                 ELSE 'validator_mismatch' END AS status
  FROM matched
)
SELECT 'v' || page_id AS record_id, url_key, 'r' || of_id AS response_id, status,
       CASE WHEN status = 'resolved' THEN concat_ws(chr(10),
              'cache-control=max-age=3600', 'content-length=' || of_bytes, 'content-type=text/html', 'date=' || late,
              'etag=' || COALESCE('"' || tag || '"', 'W/"' || of_digest || '"'), 'expires=' || (late + 3600),
              'last-modified=' || COALESCE(changed, of_seen - 86400))
            ELSE concat_ws(chr(10), 'content-type=text/plain', 'content-length=0', 'etag="' || tag || '"',
              'last-modified=' || changed, 'cache-control=max-age=3600', 'date=' || late, 'expires=' || (late + 3600))
       END AS headers,
       CASE WHEN status = 'resolved' THEN of_digest END AS payload_digest,
       CAST(CASE WHEN status = 'resolved' THEN of_bytes END AS DOUBLE) AS payload_bytes
FROM judged
""", "op11_prefix_trie": r"""
WITH own AS (
  SELECT conv_id, list({'name': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
                        'words': len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))}
                       ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), coded AS (
  SELECT *, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT) AS bytes
  FROM own
), hashed AS (
  SELECT *, xor(list_reduce(bytes, lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)),
                  lambda y, z: xor(y >> 1, 3988292384 * (y & 1))), 4294967295), 4294967295) % 4 AS h
  FROM coded
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, c.turns[1:0])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, d AS depth, array_to_string(list_transform(turns[1:d], lambda t: t.name), '') AS path,
         CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words, d = len(turns) AS is_end
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path
), children AS (
  SELECT left(path, -32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)
), below AS (
  SELECT left(path, (32 * d)::INT) AS path, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, -32)
"""}
