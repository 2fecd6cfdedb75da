"""Benchmark decontamination by SimHash windows, Hamming blocks and exact similarity.

For every benchmark item, windows of its own length are laid over the documents wherever
one of its 5-word shingles occurs (a window that holds none has similarity zero, so no
other window can match). Each window gets a 128-bit SimHash fingerprint of its weighted
shingles. Fingerprints are cut into more blocks than the search radius: by the pigeonhole
principle every pair within the radius agrees on a whole block, so an equality join on
(length, block, value) finds all of them. Candidates within the radius are verified with
the exact weighted Jaccard similarity (a shingle weighs its number of occurrences).

Only DataFrame functions are used. Document texts are read once, in a map-only pass; what
is shuffled are the windows around matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import scratch, words
from aerolytics.operators.joins import bounded_broadcast

WORDS = 5
SIMILARITY = 0.8
BLOCK_BITS = 4
BLOCKS = 128 // BLOCK_BITS
RADIUS = BLOCKS - 1              # within this distance one block is equal for certain
MAX_BROADCAST_SHINGLES = 500_000
CHUNK = 1024                     # shingles of a document that are looked up at once


def _hash(w: Column, at: Column) -> Column:
    """Hash of the shingle of ``w`` that begins at place ``at`` (from 0)."""
    return F.xxhash64(*[F.get(w, at + k) for k in range(WORDS)])


def _shingles(w: Column, start: Column, stop: Column) -> Column:
    """Hashes of the shingles inside words ``start`` to ``stop`` (exclusive)."""
    return F.when(stop - start >= WORDS, F.transform(
        F.sequence(start, stop - WORDS), lambda i: _hash(w, i))).otherwise(F.array().cast("array<bigint>"))


def _with_fingerprints(df: DataFrame, shingles: str, names: list[str]) -> DataFrame:
    """Add 64 bits for each name: bit j is the sign of the summed votes of the shingles'
    hashes (each occurrence votes; every name salts the hash)."""
    def bit(x: Column, j: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, j).bitwiseAND(F.lit(1)).cast("int")

    for salt, name in enumerate(names):
        # columns of their own: a lambda evaluates what it holds for every element
        df = df.withColumn("__votes", F.transform(shingles, lambda x, s=salt: F.xxhash64(x, F.lit(s + 1))))
        df = df.withColumn("__ones", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.aggregate(
            "__votes", F.lit(0), lambda a, x: a + bit(x, j))))
        df = df.withColumn(name, F.aggregate(F.transform("__ones", lambda n, j: F.when(
            2 * n > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(
                F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))
    return df.drop("__votes", "__ones")


def _blocks(*prints: Column) -> Column:
    """(block number, value) of all blocks of a fingerprint."""
    per = 64 // BLOCK_BITS
    return F.explode(F.array(*[F.struct(
        F.lit(k * per + b).alias("no"),
        F.call_function("shiftrightunsigned", p, F.lit(b * BLOCK_BITS)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value"))
        for k, p in enumerate(prints) for b in range(per)]))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as multisets: shared occurrences over all occurrences."""
    def times(s: Column, x: Column) -> Column:
        return F.size(F.filter(s, lambda y: y == x))

    both = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    # a value met once on one side is shared once at most
    shared = F.when(plain, F.size(both)).otherwise(
        F.aggregate(both, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))))
    return shared / (F.size(a) + F.size(b) - shared)


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, length in words, shingles and fingerprint of every item of five words or more."""
    b = benchmark.select(F.col(id_col).alias("item_id"), words(F.lower(text_col)).alias("w"))
    b = b.where(F.size("w") >= WORDS).select("item_id", F.size("w").alias("len"),
                                             _shingles(F.col("w"), F.lit(0), F.size("w")).alias("item"))
    return _with_fingerprints(b, "item", ["i1", "i2"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, similarity (of the best
    window), start_word (from 0) and n_words of that window, distance of its fingerprint.

    Case is ignored. Null, empty and short texts (below five words) hold and are no items;
    null ids are kept; rows with one id count together; equal items each match; empty
    tables give no rows; other columns are not read. Whole texts are searched.
    """
    items = scratch(benchmark_items(benchmark, item_col, item_text_col), "benchmark-items")
    # with the words around a shingle that its windows may need: ``back`` before, ``ahead`` from it on
    marks = bounded_broadcast(
        items.select("len", F.posexplode("item").alias("q", "h")).groupBy("h")
        .agg(F.collect_set(F.struct("len", "q")).alias("places"), F.max("q").alias("back"),
             F.max(F.col("len") - F.col("q")).alias("ahead")), MAX_BROADCAST_SHINGLES)
    longest = items.agg(F.max("len")).first()[0] or WORDS

    # the shingles of the documents that occur in an item (generate, hash and join in one stage).
    # That stage holds what one input row gives, so its rows are parts of texts, not whole ones,
    # and a shingle that is found goes on with the words around it only
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("t"),
                    words(F.lower(text_col)).alias("w")).where(F.size("w") >= WORDS)
    parts = F.transform(F.sequence(F.lit(0), F.size("w") - WORDS, F.lit(CHUNK)), lambda c: F.struct(
        c.alias("c"), F.slice("w", F.greatest(c - longest, F.lit(0)) + 1, CHUNK + 2 * longest).alias("w")))
    d = d.select("doc_id", "t", F.size("w").alias("size"), F.explode(parts).alias("part")).select(
        "doc_id", "t", "size", F.col("part.c").alias("c"), F.col("part.w").alias("w"))
    before = F.greatest(F.col("c") - longest, F.lit(0))              # words of the text before the part
    base = F.greatest(F.col("p") - F.col("back"), F.lit(0))          # and before those kept
    p = (d.select("doc_id", "t", "size", "c", "w", F.explode(F.sequence(
            F.col("c"), F.least(F.col("c") + CHUNK, F.col("size") - WORDS + 1) - 1)).alias("p"))
         .withColumn("h", _hash(F.col("w"), F.col("p") - before)).join(marks, "h")
         .select("doc_id", "t", "size", "p", "places", base.alias("base"),
                 F.slice("w", base - before + 1, F.col("p") + F.col("ahead") - base).alias("w")))
    # item-sized windows there
    first = F.greatest(F.col("x.start"), F.lit(0))
    last = F.least(F.col("x.start") + F.col("x.len"), F.col("size"))
    starts = F.array_distinct(F.transform("places", lambda x: F.struct(
        x["len"].alias("len"), (F.col("p") - x["q"]).alias("start"))))
    wins = (p.select("doc_id", "t", "size", "base", "w", F.explode(starts).alias("x"))
            .select("doc_id", "t", F.col("x.len").alias("len"), first.alias("start"), (last - first).alias("n"),
                    _shingles(F.col("w"), first - F.col("base"), last - F.col("base")).alias("win")))
    wins = scratch(_with_fingerprints(wins.dropDuplicates(["doc_id", "t", "len", "start", "n"]), "win", ["f1", "f2"]),
                   "benchmark-windows")

    w = wins.select("doc_id", "t", "len", "start", "n", "f1", "f2", _blocks(F.col("f1"), F.col("f2")).alias("b"))
    i = items.select("item_id", "len", "i1", "i2", _blocks(F.col("i1"), F.col("i2")).alias("b"))
    distance = F.bit_count(F.col("f1").bitwiseXOR(F.col("i1"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("i2")))
    keys = ["doc_id", "t", "len", "start", "n"]
    near = (w.join(i, ["len", "b"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
            .select(*keys, "item_id", "distance").distinct())
    same = F.lit(True)
    near, wins = near.alias("c"), wins.alias("w")
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}"))
    sim = near.join(wins.select(*keys, "win").alias("w"), same) \
        .join(items.select(F.col("item_id").alias("iid"), "item").alias("i"), F.col("c.item_id").eqNullSafe(F.col("iid"))) \
        .select("c.*", weighted_jaccard(F.col("win"), F.col("item")).alias("similarity")) \
        .where(F.col("similarity") >= similarity)
    best = F.struct((-F.col("similarity")).alias("s"), F.col("start"), F.col("n"), F.col("distance"))
    return (sim.groupBy("doc_id", "item_id").agg(F.min(best).alias("m"))
            .select("doc_id", "item_id", (-F.col("m.s")).alias("similarity"),
                    F.col("m.start").alias("start_word"), F.col("m.n").alias("n_words"),
                    F.col("m.distance").alias("distance")))
