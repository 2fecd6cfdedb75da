"""Exact token statistics from a length histogram.

Documents are encoded once and aggregated by encoded length (with map-side partial sums);
every later question is answered from the histogram: its suffix sums give, for any
context limit, how many documents are longer, the total, the truncated total and the
quantiles. The running sums are built in two levels (sums of blocks of lengths, then
inside a block), so no task ever sorts the whole histogram.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.llm.common import RecentCache, byte_slices, coded_words, scratch, ship

BLOCK = 1024
CACHE_PIECES = 150_000


class PieceCounter:
    """Token counts of whole texts under a rank file, by a bounded cache of pieces.

    The splitting rules of these vocabularies attach one space to the word behind it, so
    a space before a visible character always begins a new piece: the count of a text is
    the sum of the counts of its parts cut there.
    """

    _open: dict[str, PieceCounter] = {}
    CUT = re.compile(r" (?=\S)")

    def __init__(self, path: str, pattern: str, max_pieces: int = CACHE_PIECES):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks,
                                     special_tokens={})
        self.cache = RecentCache(max_pieces)

    @classmethod
    def get(cls, path: str, pattern: str) -> PieceCounter:
        if path not in cls._open:
            cls._open[path] = cls(path, pattern)
        return cls._open[path]

    def tokens(self, piece: str) -> int:
        return len(self.enc.encode_ordinary(piece))

    def of(self, piece: str) -> int:
        n = self.cache.lookup(piece)
        if n is None:
            n = self.tokens(" " + piece)
            if len(piece) <= 64:
                self.cache.put(piece, n)
        return n

    def slow(self, text: str) -> int:
        head, *rest = self.CUT.split(text)
        return self.tokens(head) + sum(map(self.of, rest))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text. Texts where white space follows a space (or that end in
        one) are cut by the exact rule, all others at every space."""
        codes, names, cuts = coded_words(texts, spaces_only=True)
        names = names.to_pylist()
        odd = np.array([not w or w[0].isspace() for w in names] or [False])[codes] if len(codes) else codes
        n = np.fromiter(map(self.of, names), np.int64, len(names))[codes]
        out = np.zeros(len(texts), np.int64)
        run, bad = (np.concatenate([[0], np.cumsum(x)]) for x in (n, odd))
        for i in range(len(texts)):
            a, b = cuts[i], cuts[i + 1]
            if bad[b] - bad[a] - (1 if a < b and odd[a] else 0):
                out[i] = self.slow(texts[i].as_py() or "")
            elif a < b:                                  # the first piece has no space before it
                out[i] = run[b] - run[a + 1] + self.tokens(names[codes[a]])
        return out


def token_lengths(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys`` and ``n_tokens`` (long) of every row; null and empty texts have 0."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.get(vocabulary, pattern)
        for batch in batches:
            t = batch.num_columns - 1
            for lo, hi in byte_slices(batch.column(t)):
                n = counter.counts(batch.column(t).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(t)] + [pa.array(n, pa.int64())],
                    names=batch.schema.names[:t] + ["n_tokens"])

    schema = [docs.schema[k] for k in keys]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["n_tokens long"])
    return docs.select(*[F.col(f"`{k}`") for k in keys],
                       F.col(text_col).alias("__text")).mapInArrow(run, ddl)


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens",
                     block: int = BLOCK) -> DataFrame:
    """One row per length that occurs, with what holds for a context limit of that length.

    ``n_docs`` have it; ``docs_longer`` exceed it; ``tokens_total`` is that of all
    documents; ``tokens_to`` of documents up to the limit; ``tokens_truncated`` of all
    documents cut at the limit; ``docs_to`` is the rank for quantiles. Rows with a null
    length are left out. An empty table gives no rows.
    """
    n = F.col(length_col).cast("long")
    hist = scratch(lengths.where(n.isNotNull()).groupBy(n.alias("n_tokens"))
                   .agg(F.count(F.lit(1)).alias("n_docs")), "length-histogram")
    tokens = F.col("n_tokens") * F.col("n_docs")
    key = F.floor(F.col("n_tokens") / block).cast("long")
    # one row per block of lengths: at most (longest length / block) rows
    tops = (hist.groupBy(key.alias("block"))
            .agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t")))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("block", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after")
                                  for c in ("d", "t")],
                       *[F.sum(c).over(Window.partitionBy()).alias(f"{c}_all") for c in ("d", "t")])
    inside = (Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    longer = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("d_after")
    over = F.coalesce(F.sum(tokens).over(inside), F.lit(0)) + F.col("t_after")
    out = (hist.withColumn("block", key).join(tops, "block")
           .select("n_tokens", "n_docs", longer.alias("docs_longer"), over.alias("tokens_longer"),
                   "d_all", "t_all"))
    return out.select(
        "n_tokens", "n_docs", "docs_longer",
        (F.col("d_all") - F.col("docs_longer")).alias("docs_to"),
        F.col("t_all").alias("tokens_total"),
        (F.col("t_all") - F.col("tokens_longer")).alias("tokens_to"),
        (F.col("t_all") - F.col("tokens_longer")
         + F.col("n_tokens") * F.col("docs_longer")).alias("tokens_truncated"))


def at_limit(histogram: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: documents, longer ones, total and truncated total."""
    n, d = F.col("n_tokens"), F.col("n_docs")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return histogram.agg(total(d).alias("docs"), total(F.when(n > limit, d)).alias("docs_longer"),
                         total(n * d).alias("tokens_total"),
                         total(F.least(n, F.lit(limit)) * d).alias("tokens_truncated"))


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length with at least a share ``q`` of the documents up to it."""
    docs = F.col("docs_to") + F.col("docs_longer")
    return histogram.where(F.col("docs_to") >= F.greatest(F.lit(1), F.ceil(docs * F.lit(q)))) \
        .agg(F.min("n_tokens").alias("n_tokens"))
