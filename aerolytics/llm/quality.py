"""Quality rules with adaptive thresholds per language and source.

Every document gets a handful of integer measures in one pass (built-in functions only).
The distribution of each measure is kept as a mergeable quantile sketch: counts of
buckets of three significant digits per language and source, so every quantile is known
within one per cent and a sketch has some hundred rows for each power of ten. Sketches of
the same measure merge by adding their counts, so small sources fall back on the merged
sketch of their language, and small languages on that of the whole table. Quartile fences
from the sketches replace fixed cutoffs, and a join on language and source applies them.

Most documents have no symbol, no repeated line and no repeated window, so the quartiles of
such rates are zero and say nothing. The sketches hold the rates with one event more (a
symbol, a line, a window met twice): documents without any spread by their length, the
quartiles are those of the rate that one event would make in that source, and the fence
follows. The rate that is held against the fence is the document's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.llm.common import scratch, words

# fixed values: base rules
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: measure: integer expression over the metrics, the same with one event more (per mille of
#: the words or lines; hundredths of a character for the word length, which has no events)
MEASURES = {
    "symbols": ("n_symbols * 1000 div nullif(n_words, 0)", "(n_symbols + 1) * 1000 div nullif(n_words, 0)"),
    "word_length": ("word_chars * 100 div nullif(n_words, 0)", "word_chars * 100 div nullif(n_words, 0)"),
    "dup_lines": ("n_dup_lines * 1000 div nullif(n_lines, 0)", "(n_dup_lines + 1) * 1000 div nullif(n_lines, 0)"),
    "repeats": ("n_repeat_words * 1000 div nullif(n_words, 0)", "(n_repeat_words + 6) * 1000 div nullif(n_words, 0)"),
}
TWO_SIDED = ("word_length",)
#: distance of a fence from its quartile in quartile ranges; short texts spread widely, and
#: a clean document should stay
FENCE = 8
DIGITS = 3
MIN_DOCS = 200
SMALL = 64


def text_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, lang, source, n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    gaps = " \t\n\x0b\x0c\r"
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                    F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    # a line with a word has something but white space in it
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(gaps)) != "")
    d = d.select("doc_id", "lang", "source",
                 F.length(F.translate(text, gaps, "")).cast("long").alias("word_chars"),
                 (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 lines.alias("lines"), words(text).alias("w"))
    w, h, again = F.col("w"), F.col("h"), F.col("again")
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    d = d.select("doc_id", "lang", "source", "word_chars", "n_symbols",
                 F.size(w).cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("h"))
    # values that occur twice: neighbours in the sorted hashes (a column of its own, as a
    # lambda evaluates what it holds for every element)
    d = d.withColumn("s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)).otherwise(
        F.array().cast("array<bigint>")))
    d = d.withColumn("again", F.array_distinct(F.filter("s", lambda x, i: x == F.get("s", i + 1))))
    # places of repeated windows in order: few repeated values are looked up, many are sorted
    few = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(again, F.get(h, i)))
    d = d.withColumn("pairs", F.when(F.size(again) > SMALL, F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    p = F.col("pairs")
    many = F.sort_array(F.transform(
        F.filter(p, lambda x, k: (x["h"] == F.get(p, k + 1)["h"])
                 | (F.when(k > 0, x["h"] == F.get(p, k - 1)["h"]).otherwise(False))),
        lambda x: x["i"]))
    d = d.withColumn("at", F.when(F.size(again) == 0, F.array().cast("array<int>"))
                     .when(F.size(again) <= SMALL, few).otherwise(many))
    at = F.col("at")
    covered = F.aggregate(F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return d.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines",
                    "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _measure(name: str, one_more: bool = False) -> Column:
    return F.coalesce(F.expr(MEASURES[name][one_more]), F.lit(0)).cast("long")


def _bucket(v: Column) -> Column:
    """``v`` (not negative) with all but its first three digits set to zero."""
    unit = F.pow(F.lit(10), F.greatest(F.length(v.cast("string")) - DIGITS, F.lit(0))).cast("long")
    return v - v % unit


def sketches(metrics: DataFrame) -> DataFrame:
    """Bucket counts (lang, source, measure, bucket, n) of the documents that pass the base
    rules: at most as many rows per group as a measure has buckets, and they add up."""
    rows = metrics.where(~base_failed()).select(
        "lang", "source", F.explode(F.array(*[
            F.struct(F.lit(m).alias("measure"), _bucket(_measure(m, one_more=True)).alias("bucket")) for m in MEASURES])).alias("x"))
    return (rows.groupBy("lang", "source", F.col("x.measure").alias("measure"), F.col("x.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, keys: list[str], width: int = FENCE) -> DataFrame:
    """Per group (``keys``) of merged sketches: its documents and the fences of each measure,
    ``width`` quartile ranges (one at least) beyond the quartiles."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(*keys, "measure", "bucket", F.sum("n").over(upto).alias("up"),
                           F.sum("n").over(group).alias("all"))
    q = {k: F.min(F.when(4 * F.col("up") >= k * F.col("all"), F.col("bucket"))) for k in (1, 3)}
    quart = ranked.groupBy(*keys, "measure").agg(F.max("all").alias("docs"), q[1].alias("q1"), q[3].alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(1))
    both = F.col("measure").isin(*TWO_SIDED)
    quart = quart.select(*keys, "measure", "docs", (F.col("q3") + width * spread).alias("high"),
                         F.when(both, F.col("q1") - width * spread).otherwise(-1).alias("low"))
    picks = []
    for m in MEASURES:
        for side in ("low", "high"):
            picks.append(F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}"))
    return quart.groupBy(*keys).agg(F.max("docs").alias("docs"), *picks)


def thresholds(sketch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Fences per language and source; with fewer than ``min_docs`` documents the merged
    sketch of the language, and below that of the table, takes its place."""
    names = [f"{m}_{s}" for m in MEASURES for s in ("low", "high")]
    fine = fences(sketch, ["lang", "source"])
    lang, whole = fences(sketch, ["lang"]).alias("b"), fences(sketch.withColumn("one", F.lit(1)), ["one"])
    d = (fine.withColumn("one", F.lit(1)).alias("a")
         .join(lang, F.col("a.lang").eqNullSafe(F.col("b.lang")), "left")
         .join(whole.alias("c"), F.col("a.one") == F.col("c.one"), "left"))
    return d.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"),
                    *[F.when(F.col("a.docs") >= min_docs, F.col(f"a.{n}"))
                      .when(F.col("b.docs") >= min_docs, F.col(f"b.{n}"))
                      .otherwise(F.col(f"c.{n}")).alias(n) for n in names])


def quality_filter(docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str) -> DataFrame:
    """One row per document with its metrics, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules and lies within all fences of its
    language and source. Null texts have no words (and fail the base rules); null
    languages and sources are groups of their own; null ids and repeated rows are kept;
    an empty table gives no rows; other columns are not read. Whole texts are measured.
    """
    m = scratch(text_metrics(docs, **columns), "quality-metrics")
    t = thresholds(scratch(sketches(m), "quality-sketches"), min_docs)
    m, t = m.alias("m"), t.alias("t")
    d = m.join(t, F.col("m.lang").eqNullSafe(F.col("t.lang")) & F.col("m.source").eqNullSafe(F.col("t.source")), "left")
    ok = F.lit(True)
    for name in MEASURES:
        ok = ok & F.coalesce(_measure(name).between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(True))
    failed = base_failed()
    return d.select("m.*", failed.alias("base_failed"), (~failed & ok).alias("kept"))
