"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Built-in functions only. Every text is measured once; the measures are
written, summarised as KLL sketches per (language, source), and the sketches
are merged to languages and to the whole, so that no value is read again. A
group's limit for a measure is a fence around its middle: the median plus a
multiple of the spread above it (and likewise below, for two-sided measures).
For word lengths the spread is the distance to the upper quartile. Shares are
zero for most rows; their spread is the distance to the 0.9 quantile or, if
that is larger, the median of the values above zero (of a sketch of their own)
times the share of rows that have one: what is usual for the group, weighed by
how usual it is. A group of n rows takes n / (n + ``BLEND``) of its own limit
and the rest of its language's, which is blended with the whole's alike, so
limits change smoothly with size. They are joined to the measures and rows
beyond any limit by more than one unit of their own (a symbol, a line, a
repeated window, a character) are rejected, besides those that fail the base
rules.

Null and empty texts have no words and fail the base rules. Null languages and
sources are groups like others. Rows are measured on their own: repeats and
ties need no rule. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.store import prepare, saved

BLEND = 20.0                # rows of a group that weigh as much as the level above it
SKETCH_K = 400              # sketch size: rank error under 1 %
GAP = r"[ \t\n\x0B\f\r]+"
TAIL = 0.9                  # quantile that the spread of shares is taken to
#: measure -> its count, what that is divided by, the smallest step of the count (a window that occurs twice covers
#: six words), the quantile that its spread is taken to, the spreads in a fence, and whether low values are rejected too.
MEASURES = {"symbol_share": ("n_symbols", "word_chars", 1, TAIL, 4.0, False),
            "dup_line_share": ("n_dup_lines", "n_lines", 1, TAIL, 4.0, False),
            "repeat_share": ("n_repeat_words", "n_words", 6, TAIL, 4.0, False),
            "word_length": ("word_chars", "n_words", 1, 0.75, 6.0, True)}
SHARES = [m for m, (*_, low) in MEASURES.items() if not low]


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = docs.withColumn("_text", text).withColumn("_words", F.filter(F.split("_text", GAP), lambda w: w != "")) \
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")))
    n = F.size("_words")
    gram = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    counted = cut.select(
        "*", n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.slice(gram, 1, F.greatest(n - 2, F.lit(1)))).alias("_grams")).drop("_text", "_words", "_lines")
    twice = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = counted.withColumn("_sorted", F.when(
        twice, F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("_grams")

    def again(x: Column, j: Column) -> Column:
        near = [F.get("_sorted", j + d)["g"] == x["g"] for d in (-1, 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    starts = placed.withColumn("_at", F.when(F.col("_sorted").isNotNull(), F.sort_array(
        F.transform(F.filter("_sorted", again), lambda x: x["i"])))).drop("_sorted")
    # a window covers three words, or as many as lie before the next window
    cover = F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3))))
    return starts.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(cover, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_at")


def limits(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per (lang, source): ``lo_<measure>`` and ``hi_<measure>``."""
    above = {f"{m}_above": F.when(F.col(m) > 0, F.col(m)) for m in SHARES}
    columns = {**{m: F.col(m) for m in MEASURES}, **above}
    sketch = [F.kll_sketch_agg_double(c, SKETCH_K).alias(m) for m, c in columns.items()]
    counts = [F.count("*").alias("rows"), *[F.count(c).alias(f"n_{m}") for m, c in above.items()]]
    group = saved(measured.groupBy(lang_col, source_col).agg(*counts, *sketch), "rule-sketches")

    def merged(sketches: DataFrame, *keys: str) -> DataFrame:
        joined = [F.kll_merge_agg_double(F.col(m), SKETCH_K).alias(m) for m in columns]
        sums = [F.sum(c).alias(c) for c in ("rows", *[f"n_{m}" for m in above])]
        return sketches.groupBy(*keys).agg(*sums, *joined)

    def fences(sketches: DataFrame, level: str) -> DataFrame:
        out = []
        for m, (*_, tail, wide, low) in MEASURES.items():
            quantile = lambda c, q: F.kll_sketch_get_quantile_double(F.col(c), F.lit(q))
            below, middle, top = (quantile(m, q) for q in (1 - tail, 0.5, tail))
            spread = top - middle
            if not low:
                there = F.col(f"n_{m}_above")
                spread = F.greatest(spread, F.when(there > 0, quantile(f"{m}_above", 0.5) * there / F.col("rows")))
            out.append((middle + wide * spread).alias(f"hi_{m}_{level}"))
            out.append((middle - wide * (middle - below) if low else F.lit(float("-inf"))).alias(f"lo_{m}_{level}"))
        keys = [c for c in (lang_col, source_col) if c in sketches.columns]
        return sketches.select(*keys, F.col("rows").alias(f"rows_{level}"), *out)

    by_lang = merged(group, lang_col)
    whole = fences(merged(by_lang.withColumn("_all", F.lit(1)), "_all"), "all")     # one row
    lang = fences(by_lang, "lang").withColumnRenamed(lang_col, "_lang")
    rows = fences(group, "own").join(lang, F.col(lang_col).eqNullSafe(F.col("_lang"))).join(F.broadcast(whole))

    def blended(name: str, *levels: str) -> Column:
        limit = F.col(f"{name}_{levels[0]}")
        if len(levels) == 1 or (name.startswith("lo_") and name[3:] in SHARES):
            return limit
        n = F.col(f"rows_{levels[0]}")
        return (n * limit + BLEND * blended(name, *levels[1:])) / (n + BLEND)

    return rows.select(lang_col, source_col, *[
        blended(f"{side}_{m}", "own", "lang", "all").alias(f"{side}_{m}") for m in MEASURES for side in ("lo", "hi")])


def judge(docs: DataFrame, *, keep: list[str] | None = None, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Columns ``keep`` (default doc_id) plus the base measures, base_failed and kept."""
    prepare(docs.sparkSession)
    kept = keep or ["doc_id"]
    rows = docs.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(kept)], F.col(text_col).alias("text"),
                       F.col(lang_col).alias("_lang_of"), F.col(source_col).alias("_source_of"))
    rows = base_measures(rows).drop("text")
    least = lambda m: F.greatest(F.col(MEASURES[m][1]), F.lit(1))
    rows = rows.withColumns({m: F.col(n) / least(m) for m, (n, *_) in MEASURES.items()})
    rows = saved(rows, "rule-measures")
    bounds = limits(rows, "_lang_of", "_source_of").withColumnsRenamed({"_lang_of": "_l", "_source_of": "_s"})
    unit = lambda m: F.lit(float(MEASURES[m][2])) / least(m)
    inside = reduce(lambda a, b: a & b, [F.col(m).between(F.col(f"lo_{m}") - unit(m), F.col(f"hi_{m}") + unit(m))
                                         for m in MEASURES])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    joined = rows.join(bounds, F.col("_lang_of").eqNullSafe(F.col("_l")) & F.col("_source_of").eqNullSafe(F.col("_s")))
    return joined.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(kept)], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"), (~failed & inside).alias("kept"))
