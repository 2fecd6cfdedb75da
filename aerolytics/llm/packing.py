"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

The work is map-only: every task tokenises its documents and packs them in buffers of
``buffer_tokens`` ids, so nothing is shuffled and memory is bounded whatever the table
holds. Within a buffer documents (cut to the sequence length first) are taken in
descending length and each goes to the sequence of lowest estimated cost
(``linear * n + quadratic * n * n`` summed over its pieces, the feed-forward and attention
share) that still has room for it; a piece that fits nowhere whole is cut at the room of
the cheapest open sequence. The capacities of a buffer add up to exactly its ids: full
sequences, and the rest as sequences of a power of two, which need no padding.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import RecentCache, byte_slices, coded_words, ragged, release_memory, ship

SEQUENCE_TOKENS = 4096
BUFFER_TOKENS = 1 << 20
CACHE_WORDS = 150_000
BATCH_WORDS = 4096              # chunks that the tokenizer gets at once
SLICE_BYTES = 2 << 20           # texts that are encoded at once

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, `offset` long, sequence_length long, sequence_cost double")


@functools.cache
def unsettled_letters() -> str:
    """Letters that normalise (composed, lower case) to something that ends in a mark: the
    tokenizer does not cut between them and a full stop."""
    out = []
    for c in map(chr, itertools.chain(range(0xD800), range(0xE000, sys.maxunicode + 1))):
        if c == "\u0130" or unicodedata.decomposition(c):
            last = unicodedata.normalize("NFC", c).lower()[-1:]
            if unicodedata.category(c)[0] == "L" and unicodedata.category(last)[0] != "L":
                out.append(c)
    return "".join(out)


class WordEncoder:
    """Ids of whole texts through a bounded cache of blank-free chunks.

    Only for tokenizers that drop white space and never join characters across it: the
    ids of a text are then the ids of its chunks one after another. Chunks are cut at
    spaces and line feeds; any other white space stays inside a chunk for the tokenizer.
    """

    _open: dict[str, WordEncoder] = {}

    def __init__(self, path: str, max_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark owns the cores
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.cache = RecentCache(max_words)

    @classmethod
    def get(cls, path: str) -> WordEncoder:
        """One encoder for each worker process (workers are reused between tasks)."""
        if path not in cls._open:
            release_memory()                            # what an earlier stage left in a reused worker
            cls._open[path] = cls(path)
        return cls._open[path]

    #: texts in which lower-casing early could change ids: special tokens, combining marks
    CASED = "<\\||[\u0300-\u036f]"

    #: ASCII signs but those of special tokens and elisions (< | > ')
    SIGNS = r"[!\x22#$%&()*+,\-./:;=?@\[\x5c\]^_`{}~]+"

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (little-endian unsigned 32-bit) and where each text ends in them.

        The tokenizer lower-cases, and cuts between a letter and a run of :data:`SIGNS`
        behind it; doing both first leaves far fewer distinct chunks.
        """
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        if not pc.any(pc.match_substring_regex(texts, self.CASED)).as_py():
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring_regex(texts, rf"([^\PL{unsettled_letters()}])({self.SIGNS}) ", r"\1 \2 ")
        codes, names, cuts = coded_words(texts, spaces_only=True)
        names = names.to_pylist()
        values = self.cache.lookup_all(names)
        missing = [i for i, v in enumerate(values) if v is None]
        for lo in range(0, len(missing), BATCH_WORDS):   # an encoding is far larger than its ids
            some = missing[lo:lo + BATCH_WORDS]
            new = self.tok.encode_batch_fast([names[i] for i in some], add_special_tokens=False)
            for i, e in zip(some, new):
                values[i] = array("I", e.ids).tobytes()
        self.cache.put_all((names[i], values[i]) for i in missing if len(names[i]) <= 64)
        return ragged(values, codes, cuts)


def capacities(total: int, full: int) -> list[int]:
    """Full sequences, then the binary digits of the rest: they add up to ``total``."""
    rest = total % full
    return [full] * (total // full) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                       if rest >> b & 1]


def pack(lengths: list[int], full: int, linear: float, quadratic: float):
    """Pieces ``(doc, start, length, sequence, offset)`` and the cost of each sequence."""
    room = np.asarray(capacities(sum(lengths), full), dtype=np.int64)
    size = room.copy()
    cost = np.zeros(len(room))
    todo = []                                          # descending length, then input order
    for d, n in enumerate(lengths):
        for s in range(0, n, full):
            todo.append((-min(full, n - s), d, s))
    heapq.heapify(todo)
    pieces = []
    while todo:
        n, d, s = heapq.heappop(todo)
        n = -n
        fits = room >= n
        if fits.any():
            k, take = int(np.argmin(np.where(fits, cost, np.inf))), n
        else:
            k = int(np.argmin(np.where(room > 0, cost, np.inf)))
            take = int(room[k])
            heapq.heappush(todo, (take - n, d, s + take))
        pieces.append((d, s, take, k, int(size[k] - room[k])))
        room[k] -= take
        cost[k] += linear * take + quadratic * take * take
    return pieces, cost, size


def _pack_batches(batches, path, end_id, full, linear, quadratic, buffer_tokens):
    encoder = WordEncoder.get(path)
    end = np.asarray([end_id], dtype="<u4")
    base = TaskContext.get().partitionId() << 32       # ids stay unique over tasks
    ids: list[np.ndarray] = []
    keys: list = []

    def flush():
        nonlocal base
        lengths = [len(x) for x in ids]
        pieces, cost, size = pack(lengths, full, linear, quadratic)
        cols = list(zip(*pieces))
        out = pa.RecordBatch.from_arrays([
            pa.array([keys[d] for d in cols[0]], pa.int64()),
            pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
            pa.array([zlib.crc32(ids[d][s:s + n])
                      for d, s, n, _, _ in pieces], pa.int64()),
            pa.array([lengths[d] for d in cols[0]], pa.int64()),
            pa.array([base + k for k in cols[3]], pa.int64()),
            pa.array(cols[4], pa.int64()),
            pa.array([int(size[k]) for k in cols[3]], pa.int64()),
            pa.array([float(cost[k]) for k in cols[3]], pa.float64()),
        ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                  "offset", "sequence_length", "sequence_cost"])
        base += len(size)
        ids.clear()
        keys.clear()
        return out

    held = 0
    for batch in batches:
        texts = batch.column(1)
        for lo, hi in byte_slices(texts, SLICE_BYTES):
            flat, cuts = encoder.encode(texts.slice(lo, hi - lo))
            for i, key in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                x = np.concatenate([flat[cuts[i]:cuts[i + 1]], end])
                if ids and held + len(x) > buffer_tokens:
                    yield flush()
                    held = 0
                ids.append(x)
                keys.append(key)
                held += len(x)
    if ids:
        yield flush()


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                   text_col: str = "text", end_id: int = 2,
                   sequence_tokens: int = SEQUENCE_TOKENS, linear: float = 1.0,
                   quadratic: float = 1.0 / SEQUENCE_TOKENS,
                   buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per piece: document, start and length in its ids, CRC-32 of the ids, its
    total ids (with ``end_id``), sequence, offset there, length and cost of the sequence.

    ``sequence_tokens`` must be a power of two. Null text counts as empty: such a document
    is the one id ``end_id``. A null id is kept. Equal rows are packed each for itself. An
    empty table gives no rows. Other columns of ``docs`` are not read.
    """
    if sequence_tokens < 1 or sequence_tokens & (sequence_tokens - 1):
        raise ValueError("sequence_tokens must be a power of two")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_batches(batches, tokenizer, end_id, sequence_tokens, linear, quadratic,
                             buffer_tokens)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
