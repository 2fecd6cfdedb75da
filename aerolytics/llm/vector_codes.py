"""Vector code compression: integer product codes with per-dimension value dictionaries.

Components become integers ``floor(scale * x)``; a vector is cut into equal consecutive
parts and each part is replaced by the index of its codebook's nearest entry. Codebooks
start as the parts of the first vectors by id and are moved in rounds to the floored mean
of what they were assigned.

Distances are never computed per vector. In a block of vectors every dimension gets a
dictionary of its distinct integers, and the squared differences of these to all entries
are tabulated once; the distance of a part is then a gather of table rows by dictionary
code and an addition, in integers. Ties go to the lower index.

Each round is one map-only scan of the integer table that leaves at most
``parts * entries * (part length + 1)`` sums a task; these are added by one aggregate, and
what the driver sees is the codebook alone, whose size is a parameter.

Defined results: a vector that is null or holds a null or non-finite component is dropped;
an empty vector is kept; shorter vectors count as filled up with zeros to the longest
length, and that to a multiple of ``parts``; components beyond the exact integer range
(2^28 for parts of 16) are held at its ends. Fewer vectors than entries give fewer
entries. Null ids come last, repeated ids in the order of their components, and null
labels are one label. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import scratch, ship

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CHUNK = 1024                     # vectors whose distances to all entries are held at once


def component_limit(length: int) -> int:
    """Integers up to here have squared distances of ``length`` components below 2^63."""
    return 1 << ((62 - max(length - 1, 0).bit_length()) // 2 - 1)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, parts: int) -> DataFrame:
    """``id``, ``label`` and the integer components ``v`` of the vectors that are kept."""
    v = F.col(f"`{vector_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(v.isNotNull() & ~bad).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.cast("array<double>").alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    limit = float(component_limit(-(-longest // parts)))

    def whole(x):
        return F.floor(F.least(F.greatest(x * float(scale), F.lit(-limit)), F.lit(limit))).cast("int")

    return kept.select("id", "label", F.transform("v", whole).alias("v"))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == length).all():
        return flat.reshape(-1, length)
    out = np.zeros((len(sizes), length), np.int32)
    out[np.arange(length) < sizes[:, None]] = flat
    return out


def nearest(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and summed squared distances of a block of integer vectors;
    ``books`` is parts x entries x part length."""
    parts, entries, width = books.shape
    n = len(block)
    codes, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
    if not n or not width:
        return codes, error
    reach = max(int(block.max()), int(books.max())) - min(int(block.min()), int(books.min()))
    kind = np.int32 if reach * reach * width < 1 << 31 else np.int64
    rows = min(n, CHUNK)
    total, part = np.empty((rows, entries), kind), np.empty((rows, entries), kind)
    for p in range(parts):
        tables = []
        for j in range(width):
            values, at = np.unique(block[:, p * width + j], return_inverse=True)
            gap = values.astype(kind)[:, None] - books[p, :, j].astype(kind)[None, :]
            tables.append((gap * gap, at))
        for lo in range(0, n, rows):
            m = min(rows, n - lo)
            np.take(tables[0][0], tables[0][1][lo:lo + m], axis=0, out=total[:m], mode="clip")
            for table, at in tables[1:]:
                np.take(table, at[lo:lo + m], axis=0, out=part[:m], mode="clip")
                total[:m] += part[:m]
            best = total[:m].argmin(axis=1)
            codes[lo:lo + m, p] = best
            error[lo:lo + m] += total[np.arange(m), best]
    return codes, error


def starting_books(store: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """The parts of the ``entries`` smallest ids."""
    first = store.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    rows = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        rows[i, :len(r["v"])] = r["v"]
    return np.ascontiguousarray(rows.reshape(len(first), parts, width).transpose(1, 0, 2))


def moved_books(store: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts nearest to it."""
    parts, entries, width = books.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            block = matrix(batch.column(0), parts * width)
            codes, _ = nearest(block, books)
            for p in range(parts):
                sums[p, :, width] += np.bincount(codes[:, p], minlength=entries)
                for j in range(width):               # exact: a batch's sums are below 2^53
                    sums[p, :, j] += np.bincount(codes[:, p], block[:, p * width + j], entries).astype(np.int64)
        flat = sums.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.int64())], names=["at", "n"])

    total = np.zeros(parts * entries * (width + 1), np.int64)
    for r in store.select("v").mapInArrow(partial, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r["at"]] = r["n"]
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def code_vectors(store: DataFrame, books: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` and ``error`` of every vector of the integer table."""
    parts, entries, width = books.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    names = np.array([f"{i:0{digits}x}" for i in range(max(entries, 1))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = nearest(matrix(batch.column(2), parts * width), books)
            text = names[codes].sum(axis=1) if len(codes) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                names=["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in store.schema.fields}
    return store.select("id", "label", "v").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def fit_codebooks(store: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x part length) after all rounds."""
    longest = store.agg(F.max(F.size("v"))).first()[0] or 0
    books = starting_books(store, parts, entries, -(-longest // parts))
    if books.shape[1]:
        for _ in range(rounds):
            books = moved_books(store, books)
    return books


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``id_col``, ``code``, ``error``, ``label_error`` (the errors of all vectors of the
    same label) and ``codebooks_sha256`` of every kept vector."""
    ship(vectors.sparkSession)
    store = scratch(integer_vectors(vectors, id_col, vector_col, label_col, scale, parts), "vectors")
    books = fit_codebooks(store, parts, entries, rounds)
    coded = scratch(code_vectors(store, books), "vector-codes")
    of_label = coded.groupBy(F.col("label").alias("other")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("other"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
