"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets of bounded size by a seeded hash of each
row's place in its file (not of its content, so that copies and repeated rows spread like
all others). Pass two takes one bucket at a time into memory, puts it into the order of a
second seeded hash (rows arrive from a shuffle in any order), shuffles it with
Fisher-Yates under a seed of its own and writes it. The buckets one after the other are a
uniform permutation of the table; it is cut into shards whose counts are at most one apart
(law ``rows``), and ``slot`` is the place in the shard.

A bucket holds about ``bucket_bytes`` of text; there are at least as many as shuffle
partitions. Counts of buckets are added up in two levels, so one task orders about the
square root of their number. Every record is moved once.

Defined results: null and empty texts and ids are rows like others; an empty table gives no
rows; a single text beyond the bucket size makes its bucket that much larger. Input columns
named ``shard`` or ``slot`` are replaced. The order follows from the seed and the files'
names and rows; a table that is not read from files is written once first.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolytics.llm.common import file_rows, ship
from aerolytics.session import ensure_checkpoint_dir

SHARDS = 24
SEED = 12
BUCKET_BYTES = 32 << 20
LAW = "rows"


def offsets_of(buckets: DataFrame) -> DataFrame:
    """``bucket`` and ``off``: the rows of all earlier buckets, in two levels."""
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("group", F.floor(F.col("bucket") / 1024))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("group").agg(F.sum("n").alias("n")).select(
        "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(groups, "group").select("bucket", (F.col("base") + F.col("inside")).alias("off"))


def shuffled(rows: int, seed: int, bucket: int) -> np.ndarray:
    """A Fisher-Yates permutation of 0 .. rows - 1."""
    order = np.arange(rows)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def shard_of(position: np.ndarray, rows: int, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of positions in a table of ``rows`` rows: shard k starts at floor(k * rows / shards)."""
    shard = (n_shards * (position + 1) - 1) // rows
    return shard, position - shard * rows // n_shards


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED, text_col: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` to ``path``, one folder per shard with the rows in the order of their
    slots in each file, and return the table: all columns, ``shard`` and ``slot``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("shard", "slot")
    names = [f"`{c}`" for c in docs.columns]
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(f"`{text_col}`"))).alias("bytes")).first()
    n, least = size["n"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-(size["bytes"] or 0) // bucket_bytes))
    placed = file_rows(docs)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "__file", "__row"), F.lit(buckets)).alias("__bucket")
    tag = F.xxhash64("__row", "__file", F.lit(seed)).alias("__tag")
    offsets = offsets_of(placed.select(bucket.alias("bucket"))).withColumnRenamed("bucket", "__bucket")
    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def shuffle(held: pa.Table, off: pa.Table) -> pa.Table:
        order = np.argsort(held.column("__tag").to_numpy(), kind="stable")
        at = shuffled(len(order), seed, held.column("__bucket")[0].as_py() if len(order) else 0)
        out = held.take(pa.array(order[at])).drop_columns(["__bucket", "__tag"])
        first = off.column("off")[0].as_py() if len(off) else 0
        shard, slot = shard_of(first + np.arange(len(order)), n, n_shards)
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    done = placed.select(*names, bucket, tag).groupBy("__bucket").cogroup(offsets.groupBy("__bucket")) \
        .applyInArrow(shuffle, schema)
    done.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path).select(*names, "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The shards of ``docs`` in a new folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(docs.sparkSession).rstrip("/")
    return write_shards(docs, f"{root}/shards-{uuid.uuid4().hex}", n_shards, seed)
