"""The training-data pipeline: toxicity, line dedup, n-gram Jaccard join, benchmark
decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``docs`` (a text that was cut has its ``n_chars`` counted anew). ``run`` writes the result
of each stage below the shared checkpoint folder and reads it back for the next.

Every stage decides row by row, by a key that is the ``doc_id`` where ids are unique and a
number where they are null or shared: a leak in one of several rows with one id drops that
row alone, and a copy without an id goes like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolytics.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from aerolytics.llm.common import BLANKS, scratch, table
from aerolytics.llm.queries import vocabulary

#: the first stage fits a field and the last returns pieces; neither has a SQL form, so the
#: tests hold every stage against a brute-force version
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn("__score", toxicity.toxic_scores(docs, model)) \
        .where(F.col("__score") < 0.5).drop("__score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line matches. A document goes if it had
    words and no line with a word is left; one that was empty before stays."""
    d = line_dedup.row_keys(docs, "doc_id")
    gone = line_dedup.find_duplicate_lines(d)
    cut = line_dedup.remove_lines(d.withColumn("__before", F.xxhash64("text")), gone)
    changed = ~F.col("__before").eqNullSafe(F.xxhash64("text"))
    kept = cut.where(~changed | (F.btrim(F.col("text"), F.lit(BLANKS)) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _by_key(docs: DataFrame) -> DataFrame:
    """The texts with the key of their row as ``doc_id``."""
    return docs.select(F.col("__row").alias("doc_id"), "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id, null ids last) of each component of linked documents."""
    d = line_dedup.row_keys(docs, "doc_id")
    links = scratch(ngram_join.link_components(_by_key(d)), "pipeline-links")
    groups = links.select(F.col("doc_id").alias("__row"), "component_id").join(
        d.select("__row", F.coalesce(F.col("doc_id").cast("long"), F.lit(line_dedup.NO_ID)).alias("id")), "__row")
    first = groups.groupBy("component_id").agg(F.min(F.struct("id", "__row"))["__row"].alias("first"))
    dropped = scratch(groups.join(first, "component_id").where("__row <> first").select("__row"), "pipeline-copies", release=True)
    return d.join(dropped, "__row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    d = line_dedup.row_keys(docs, "doc_id")
    leaks = decontaminate.find_leaks(_by_key(d), table(spark, sf_dir, "benchmark"))
    hit = scratch(leaks.select(F.col("doc_id").alias("__row")).distinct(), "pipeline-leaks")
    return d.join(hit, "__row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}", release=True)
    return STAGES[-1][1](spark, docs, sf_dir)
