"""Target-distribution importance resampling on hashed word features.

Features are all runs of one and two consecutive words, hashed into buckets by CRC-32.
The bucket counts of the corpus and of the target texts give every bucket an integer gain
(a smoothed log ratio); a document weighs the floored mean gain of its features. Adding
Gumbel noise from a hash of the id and keeping the highest scores draws documents without
replacement in proportion to their weights.

* *Array-scored weights.* Both passes over the texts are map-only: words are coded per
  Arrow block, a word's CRC is taken once per block, and the CRC of a pair follows from
  those of its words with a table of the zero-byte shift (CRCs are linear), so weights are
  gathers in an array of gains. The corpus counts of all buckets are added by one aggregate.
* *Ranking by a distributed LSD radix sort.* The composite key (score downwards, null ids
  last, id upwards) is cut into digits of ``DIGIT_BITS``. A pass is a stable counting sort:
  every block of consecutive positions numbers its rows within each digit, the histogram of
  (digit, block) gives the global prefix offsets, and offset plus number is a row's new
  position. After the last pass the position is the rank. A block holds about 2^20 rows at
  most, whatever the keys are; what one task orders globally is one row a digit.

Defined results: null and empty texts have no features and weight 0; a null id is hashed as
the empty string; equal score and id keep the order of the scored table. Other columns are
ignored. Each pass writes its rows below the checkpoint folder, so positions do not depend
on retries.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.llm.common import byte_slices, coded_words, file_rows, scratch, ship

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
DIGIT_BITS = 11
BLOCK_ROWS = 1 << 20
NEAR = 64                        # words up to so many bytes have a shift table

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


# --- features ---------------------------------------------------------------------------

def _crc_steps() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_STEP = _crc_steps()


def _shift_tables() -> np.ndarray:
    """``[n, k, b]``: the register holding byte ``b`` at place ``k``, after ``n`` zero bytes."""
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [now]
    for _ in range(NEAR):
        now = _STEP[now & 255] ^ (now >> 8)
        out.append(now)
    return np.stack(out)


_SHIFT = _shift_tables().ravel()


def feature_words(texts: pa.Array):
    """Codes, dictionary (bytes) and cuts of the words: runs of a-z, 0-9 and non-ASCII
    characters after A-Z are lower-cased."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = bytes(memoryview(data)[ends[0]:ends[-1]]).translate(_WORD_BYTES) if data is not None else b""
    plain = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((ends - ends[0]).tobytes()),
                                                            pa.py_buffer(body)])
    codes, names, cuts = coded_words(plain)
    return codes, names.cast(pa.binary()).to_pylist(), cuts


def feature_buckets(texts: pa.Array, buckets: int):
    """Bucket of every word, bucket of the pair that starts there (-1 at a text's last
    word), and the cuts of the texts."""
    codes, names, cuts = feature_words(texts)
    crc = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), cuts
    size = np.fromiter(map(len, names), np.int64, len(names))
    state = ~crc
    led = ~(_STEP[(state ^ np.uint32(32)) & 255] ^ (state >> 8))         # the word and a blank
    first, second = codes[:-1], codes[1:]
    a, table = led[first], np.minimum(size, NEAR)[second] * 1024
    pair = crc[second]
    for k in range(4):
        pair ^= _SHIFT[table + 256 * k + ((a >> np.uint32(8 * k)) & 255)]
    for i in np.flatnonzero(size[second] > NEAR):
        pair[i] = zlib.crc32(names[second[i]], int(a[i]))
    pairs = np.full(len(codes), -1, np.int64)
    pairs[:-1] = pair % np.uint32(buckets)
    pairs[cuts[1:][cuts[1:] > cuts[:-1]] - 1] = -1
    return (crc % np.uint32(buckets)).astype(np.int64)[codes], pairs, cuts


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket (what is collected has the size of ``buckets``)."""
    ship(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for lo, hi in byte_slices(batch.column(0)):
                one, two, _ = feature_buckets(batch.column(0).slice(lo, hi - lo), buckets)
                total += np.bincount(one, minlength=buckets) + np.bincount(two[two >= 0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["b", "n"])

    out = np.zeros(buckets, np.int64)
    parts = texts.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "b int, n long")
    for r in parts.groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target to corpus) per bucket."""
    k, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (all_s + k)) / ((s + 1) * (all_t + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every document."""
    ship(docs.sparkSession)
    both = np.append(gains, 0)                                           # bucket -1: no pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column(1)):
                one, two, cuts = feature_buckets(batch.column(1).slice(lo, hi - lo), len(gains))
                upto = np.concatenate([[0], np.cumsum(both[one] + both[two])])
                words = np.diff(cuts)
                n = np.maximum(2 * words - 1, 0)
                weight = (upto[cuts[1:]] - upto[cuts[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (words, n, weight))],
                    names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of sha256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# --- ranking ----------------------------------------------------------------------------

def _shift_right(x: Column, n: int) -> Column:
    return F.call_function("shiftrightunsigned", x, F.lit(n)) if n else x


def digits(parts: list[tuple[Column, int]], bits: int) -> list[Column]:
    """The digits, lowest first, of a composite key: ``parts`` are (non-negative or unsigned
    64-bit value, number of low bits that count), the most significant part first."""
    ranges, at = [], 0
    for col, n in reversed(parts):
        ranges.append((col, at, n))
        at += n
    out = []
    for lo in range(0, at, bits):
        digit = F.lit(0).cast("long")
        for col, start, n in ranges:
            a, z = max(lo, start), min(lo + bits, start + n)
            if a < z:
                piece = _shift_right(col, a - start).bitwiseAND(F.lit((1 << (z - a)) - 1))
                digit = digit.bitwiseOR(F.call_function("shiftleft", piece, F.lit(a - lo)))
        out.append(digit.cast("int"))
    return out


def number_in_digits(block: pa.Table) -> pa.Table:
    """Counting sort of one block: ``nth`` is a row's number, from 0 and in order of ``at``,
    among the rows of its digit."""
    order = np.argsort(block.column("at").to_numpy(), kind="stable")
    digit = block.column("digit").to_numpy().astype(np.uint16)[order]
    by_digit = np.argsort(digit, kind="stable")                          # 16 bits: numpy's radix sort
    counts = np.bincount(digit)
    start = np.cumsum(counts) - counts
    nth = np.empty(len(order), np.int64)
    nth[order[by_digit]] = np.arange(len(order)) - start[digit[by_digit]]
    return block.drop_columns(["at"]).append_column("nth", pa.array(nth))


def prefix_offsets(rows: DataFrame, block: list[str]) -> DataFrame:
    """First position of every (digit, block): rows of smaller digits, and of the same digit
    in earlier blocks. One task orders the totals of all digits, at most 2^DIGIT_BITS rows;
    a digit's window holds one row a block."""
    counts = rows.groupBy("digit", *block).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("digit").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select("digit", *block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inside"))
    totals = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("base"))
    return inside.join(base, "digit").select("digit", *block, (F.col("base") + F.col("inside")).alias("off"))


def radix_ranks(rows: DataFrame, parts: list[tuple[Column, int]], n_rows: int, bits: int = DIGIT_BITS,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows``, a table of files, with ``pos``: the place (0, 1, 2 ...) of each row in the
    order of the composite key, stable. Blocks are at least as many as shuffle partitions."""
    spark = rows.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // block_rows))
    size = max(1, -(-n_rows // blocks))
    names = rows.columns
    now = file_rows(rows).withColumn("chunk", F.floor(F.col("__row") / size)).withColumnRenamed("__row", "at")
    block = ["__file", "chunk"]
    for i, digit in enumerate(digits(parts, bits)):
        held = now.withColumn("digit", digit)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields if f.name != "at")
        numbered = scratch(held.groupBy(*block).applyInArrow(number_in_digits, f"{kinds}, nth long"), f"radix-{i}")
        pos = (F.col("off") + F.col("nth")).alias("pos")
        now = numbered.join(prefix_offsets(numbered, block), ["digit", *block]).select(*names, pos)
        now = now.select(*names, "pos", F.floor(F.col("pos") / size).alias("block"), F.pmod("pos", F.lit(size)).alias("at"))
        block = ["block"]
    return now.select(*names, "pos")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             bits: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every document's id, ``n_features``, ``weight``, ``score`` and ``rank``. Of the N
    documents with ``min_words`` words the ``percent * N // 100`` highest scores are drawn
    and ranked, ties to the smaller id; the rank of the others is null. Ids are integers."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    weighed = weigh(docs, gains, id_col, text_col)
    scored = scratch(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "importance")
    able = scratch(scored.where(F.col("n_words") >= min_words).drop("n_words"), "importance-able")
    b = able.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s0"), F.max("score").alias("s1"),
                 F.min("id").alias("i0"), F.max("id").alias("i1")).first()
    rank = F.lit(None).cast("long")
    if b["n"]:
        ids = F.col("id").cast("long")
        low, high = (b["i0"], b["i1"]) if b["i0"] is not None else (0, 0)
        # bits above the highest one that differs are the same in all ids
        width = (low ^ high).bit_length() if (low < 0) == (high < 0) else 64
        if width == 64:
            ids = ids.bitwiseXOR(F.lit(-1 << 63))
        parts = [(F.lit(b["s1"]) - F.col("score"), (b["s1"] - b["s0"]).bit_length()),
                 (F.col("id").isNull().cast("long"), 1), (F.coalesce(ids, F.lit(0).cast("long")), width)]
        able = radix_ranks(able, parts, b["n"], bits, block_rows)
        rank = F.when(F.col("pos") < b["n"] * percent // 100, F.col("pos") + 1).alias("rank")
    out = [F.col("id").cast("long").alias(id_col), "n_features", "weight", "score"]
    few = scored.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return able.select(*out, rank.alias("rank")).unionAll(few)
