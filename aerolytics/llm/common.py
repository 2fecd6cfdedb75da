"""Helpers shared by the training-data operators: word rules, hashing, shared scratch tables.

A *word* is a run of characters other than space and U+0009..U+000D everywhere in this
package, and lower-casing touches A-Z only, so results do not depend on locale or on the
Unicode version of an engine.
"""

from __future__ import annotations

import ctypes
import itertools
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolytics.session import ensure_checkpoint_dir

#: fixed values: the white space that separates words
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package (a cluster installs it)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), _ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, label: str, hashes: bool = False, release: bool = False) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can reach, so a lost executor costs
    a reread instead of a recomputation; the small derived tables of this package use it
    where a result is read more than once. ``hashes``: mostly random values, which no
    dictionary makes smaller. ``release``: the shuffle files behind the table are given back
    when it is written (:func:`released`).
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    with released(spark) if release else nullcontext():
        df.write.option("parquet.enable.dictionary", str(not hashes).lower()).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Queries run inside give their shuffle files back as they end; nothing reads them again, but
    Spark else removes them only some time after the driver happens to collect its garbage."""
    old = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, old)


def file_rows(df: DataFrame) -> DataFrame:
    """``df`` with ``__file`` (name) and ``__row`` (place in it): a number of each row that a
    retry cannot change. A table that is not read from Parquet files is written once first."""
    place = [F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        return df.select("*", *place)
    except AnalysisException:                            # no file columns behind this plan
        return scratch(df, "rows").select("*", *place)


def discard(*tables: DataFrame) -> None:
    """Remove :func:`scratch` tables that no later step reads."""
    for t in tables:
        for path in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            p = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column) -> Column:
    """Array of the words of a text; null or blank text has none."""
    body = F.btrim(F.coalesce(col, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, GAP))


def release_memory() -> None:
    """Give freed memory back to the system: reused workers of several stages share a machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):                    # a C library without it
        pass


def byte_slices(batch_column, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow column whose values hold at most ``max_bytes`` together
    (a single larger value is a range of its own)."""
    start = held = 0
    for i, v in enumerate(batch_column):
        n = len(v.as_buffer()) if v.is_valid else 0
        if i > start and held + n > max_bytes:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(batch_column):
        yield start, len(batch_column)
    release_memory()


def coded_words(texts: pa.Array, spaces_only: bool = False, lower: bool = False):
    """Words of an Arrow column as codes: ``(codes, dictionary, cuts)``.

    ``codes[cuts[i]:cuts[i + 1]]`` are the words of row ``i`` as indices into the
    dictionary, so Python touches every distinct word of the column once. Words are split
    at white space (see :data:`BLANKS`), or with ``spaces_only`` at single spaces, where
    empty words stay. Null counts as empty.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.split_pattern(texts, " ") if spaces_only else pc.ascii_split_whitespace(texts)
    coded = parts.values.slice(parts.offsets[0].as_py(), parts.offsets[-1].as_py() - parts.offsets[0].as_py())
    coded = coded.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    cuts = parts.offsets.to_numpy().astype(np.int64)
    cuts = cuts - cuts[0]
    if not spaces_only:                                  # blank ends of a text make empty words
        empty = pc.index(coded.dictionary, "").as_py()
        if empty >= 0:
            real = codes != empty
            cuts = np.concatenate([[0], np.cumsum(real)])[cuts]
            codes = codes[real]
    return codes, coded.dictionary, cuts


class RecentCache(dict):
    """A dictionary of two generations, each of at most ``limit`` entries: when the young
    one is full it becomes the old one, and what is asked for again moves over."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def lookup(self, key):
        v = self.get(key)
        if v is None and (v := self.old.get(key)) is not None:
            self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def lookup_all(self, keys: list) -> list:
        """:meth:`lookup` of many keys."""
        found = list(map(self.get, keys))
        if self.old:
            found = [self.lookup(k) if v is None else v for k, v in zip(keys, found)]
        return found

    def put_all(self, items) -> None:
        """:meth:`put` of many pairs, as many at a time as there is room for."""
        items = iter(items)
        while some := list(itertools.islice(items, max(1, self.limit - len(self)))):
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self.update(some)


def ragged(values: list[bytes], codes: np.ndarray, cuts: np.ndarray, step: int = 1 << 16):
    """Concatenate the 32-bit values ``values[c]`` for all codes; returns them and the cuts
    of the rows in them. ``step`` codes are looked up at once: the 64-bit places of all values
    would take several times their room."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    flat = np.frombuffer(b"".join(values), "<u4")
    first = np.cumsum(sizes) - sizes
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    out = np.empty(int(ends[-1]), "<u4")
    for lo in range(0, len(codes), step):
        some, end = codes[lo:lo + step], ends[lo:lo + step + 1]
        at = np.repeat(first[some] - end[:-1], np.diff(end)) + np.arange(end[0], end[-1])
        out[end[0]:end[-1]] = flat[at]
    return out, ends[cuts]


SIEVE_WORDS = 1 << 16


def may_occur(wanted: DataFrame, col: str, n_words: int = SIEVE_WORDS) -> Column:
    """False only where ``col`` does not occur in ``wanted``: a bitmap of fixed size
    (``n_words`` 64-bit words). The values that pass still need a join that decides."""
    def shift(name, x, k):
        return F.call_function(name, x, k)

    spot = F.pmod(F.xxhash64(col), F.lit(n_words * 64))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    at, bit = shift("shiftright", spot, F.lit(6)), spot.bitwiseAND(F.lit(63)).cast("int")
    bits = (wanted.select(at.alias("w"), shift("shiftleft", one, bit).alias("v"))
            .unionAll(wanted.sparkSession.range(n_words).select(F.col("id").alias("w"), zero.alias("v")))
            .groupBy("w").agg(F.bit_or("v").alias("v"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "v"))), lambda s: s["v"]).alias("s")))
    word = F.get(bits.scalar(), at.cast("int"))
    return F.coalesce(shift("shiftrightunsigned", word, bit).bitwiseAND(one), one) == 1


def sieve(df: DataFrame, wanted: DataFrame, col: str, n_words: int = SIEVE_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``col`` may occur in ``wanted``: drops most others before a join,
    so that wide rows are not shuffled for nothing. A full bitmap lets everything through."""
    return df.where(may_occur(wanted, col, n_words))
