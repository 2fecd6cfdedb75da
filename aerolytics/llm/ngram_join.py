"""Exact n-gram Jaccard join by T-occurrence search (DivideSkip), with link components.

A document's set holds its distinct 5-word shingles (64-bit hashes). Two sets link when
their Jaccard similarity reaches the threshold. The search works on inverted lists:

1. Any partner shares at least ``T = ceil(t * n)`` of a set's ``n`` shingles, so under one
   global order (the hash) the first ``n - T + l`` shingles of two linked sets share at
   least ``l``. Only these go into the inverted lists, ``l`` about a twentieth of the set.
2. Lists of one row are dropped, and so is every set with fewer than ``l`` lists left:
   documents that only share some passage with others end here.
3. DivideSkip on these lists: of the ``N`` lists of a set that must be met ``l`` times, its ``l - 1``
   longest are set aside. A partner is met in at least one of the others, the short
   lists; these are merged by Spark's sorted shuffle on the list key (the heap of a single
   machine). Long lists are probed later by binary search in the sorted set.
4. Candidates are verified exactly: binary probes of one sorted set in the other.

Only components are asked for, so the pairs of a group of copies are never spelled out.
Equal sets are one node. One round compares every node with the leader (the set with the
most popular shingles) of its lists. Lists of one leader then form a block; the nodes of a
block that are not in its largest component yet search the block's index, in pieces of
bounded size, by DivideSkip inside the task: the postings of the short lists are merged,
what reaches the count that is left is probed in the long ones by binary search. Within a
task links already known are not searched for again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.llm.common import byte_slices, coded_words, scratch, ship, sieve

WORDS = 5
PERCENT = 80
CHUNK_SHINGLES = 500_000         # of a piece of a block's index
MU = 0.05                        # weight of a probe against a merge when lists are divided
SPARE = 20                       # one more shared list is asked for per so many shingles

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C2
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, k: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (signed 64-bit) of every text; a text of fewer
    than ``k`` words is one shingle, a text without words none."""
    import xxhash
    codes, names, cuts = coded_words(texts, lower=True)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()), np.uint64, len(names))
    w = h[codes] if len(codes) else np.zeros(0, np.uint64)
    n = max(0, len(w) - k + 1)
    s = w[:n].copy()
    for j in range(1, k):
        s = _mix(s) * _C1 + w[j:j + n]
    s = _mix(s * _C1 + np.uint64(k)).view(np.int64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= k:
            x = np.sort(s[a:b - k + 1])
            yield x[np.concatenate([[True], x[1:] != x[:-1]])]
        elif b > a:
            x = w[a:a + 1]
            for j in range(a + 1, b):
                x = _mix(x) * _C1 + w[j:j + 1]
            yield _mix(x * _C1 + np.uint64(b - a)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def least_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + 1 + n // SPARE)


def _sets(docs: DataFrame, k: int, percent: int, full: bool) -> DataFrame:
    """doc_id, n, node (hash of the whole set) and the prefix, or the whole set as bytes."""
    ship(docs.sparkSession)
    kind = pa.binary() if full else pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            for lo, hi in byte_slices(batch.column(1)):
                n, node, out = [], [], []
                for x in shingle_sets(batch.column(1).slice(lo, hi - lo), k):
                    n.append(len(x))
                    node.append(xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63))
                    out.append(x.tobytes() if full else x[:prefix_length(len(x), percent)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(node, pa.int64()), pa.array(out, kind)], names=["doc_id", "n", "node", "part"])

    return docs.mapInArrow(run, f"doc_id long, n long, node long, part {'binary' if full else 'array<long>'}")


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that two linked sets may have."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for x, y in zip(t.column(2), t.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(0).filter(keep), t.column(1).filter(keep)], names=["a", "b"])

    x, y = sets.select(F.col("node").alias("a"), F.col("part").alias("x")), \
        sets.select(F.col("node").alias("b"), F.col("part").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class BlockIndex:
    """Inverted lists of the sets of one piece of a block, and what is linked already."""

    def __init__(self, nodes: list[int], comps: list[int], sets: list[np.ndarray], percent: int):
        self.nodes, self.sets, self.percent = nodes, sets, percent
        self.sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.posts = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.keys, first = np.unique(flat[order], return_index=True)
        self.ends = np.append(first, len(flat))
        self.at = {v: i for i, v in enumerate(nodes)}
        self.root: dict[int, int] = {}
        self.comp = comps

    def find(self, c: int) -> int:
        while (p := self.root.get(c, c)) != c:
            self.root[c] = self.root.get(p, p)
            c = p
        return c

    def search(self, node: int, comp: int, x: np.ndarray) -> Iterator[int]:
        """Nodes that ``x`` links with, one for each component not linked with it yet."""
        n, pc = len(x), self.percent
        least = -(-pc * (n + least_overlap(n, pc)) // (100 + pc))        # for the smallest partner
        k = np.searchsorted(self.keys, x)
        k = k[(k < len(self.keys)) & (self.keys[np.minimum(k, len(self.keys) - 1)] == x)]
        if len(k) < least:
            return
        size = self.ends[k + 1] - self.ends[k]
        order = np.argsort(size, kind="stable")
        n_long = min(least - 1, int(least / (MU * np.log2(int(size.max()) + 1) + 1)))
        short, long = k[order[:len(k) - n_long]], np.sort(k[order[len(k) - n_long:]])
        met = np.bincount(np.concatenate([self.posts[self.ends[i]:self.ends[i + 1]] for i in short]),
                          minlength=len(self.nodes))
        need = -(-pc * (n + self.sizes) // (100 + pc))
        cand = np.flatnonzero((met > 0) & (met >= need - n_long)
                              & (100 * np.minimum(n, self.sizes) >= pc * np.maximum(n, self.sizes)))
        probes = self.keys[long]
        for c in cand[np.argsort(-met[cand], kind="stable")].tolist():
            mine, theirs = self.find(comp), self.find(self.comp[c])
            if self.nodes[c] == node or mine == theirs:
                continue
            y = self.sets[c]
            at = np.minimum(np.searchsorted(y, probes), len(y) - 1)
            if met[c] + int((y[at] == probes).sum()) >= need[c]:
                self.root[max(mine, theirs)] = min(mine, theirs)
                yield self.nodes[c]


def search_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in rows (block, piece, query, node, comp, part) that come sorted:
    the sets of a piece, then its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, index, held = None, None, ([], [], [])
        for t in batches:
            a, b = [], []
            cols = [t.column(i).to_pylist() for i in range(5)]
            for i, (block, piece, query, node, comp) in enumerate(zip(*cols)):
                x = np.frombuffer(t.column(5)[i].as_buffer(), np.int64)
                if (block, piece) != here:
                    here, index, held = (block, piece), None, ([], [], [])
                if not query:
                    held[0].append(node)
                    held[1].append(comp)
                    held[2].append(x.copy())
                elif held[0]:
                    if index is None:
                        index = BlockIndex(*held, percent)
                    for other in index.search(node, comp, x):
                        a.append(node)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, comp of every node of an edge. Each round maps every node to the neighbour (or
    itself) of least random priority and contracts; the graph shrinks by a constant factor,
    so rounds grow with the logarithm of the largest component."""
    def ordered(a, b):
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    e = scratch(edges.where("a <> b").select(*ordered(F.col("a"), F.col("b"))).distinct(), "edges")
    labels = None
    k = 0
    while labels is None or not e.isEmpty():
        def rank(c):
            return F.struct(F.xxhash64(c, F.lit(k)).alias("p"), c.alias("v"))
        both = e.select("a", "b").unionAll(e.select(F.col("b"), F.col("a")))
        m = scratch(both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
                    .select(F.col("a").alias("node"), F.least("m", rank(F.col("a")))["v"].alias("to")), "hooks")
        if labels is None:
            labels = m.select("node", F.col("to").alias("comp"))
        else:
            labels = scratch(labels.join(m.select(F.col("node").alias("comp"), "to"), "comp", "left")
                             .select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        e = scratch(e.join(m.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                    .join(m.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                    .where("x <> y").select(*ordered(F.col("x"), F.col("y"))).distinct(), "edges")
        k += 1
    return labels


def _short_lists(base: DataFrame, percent: int) -> DataFrame:
    """key, node, n: the short lists of the sets that may have a partner."""
    entries = base.where("n > 0").select("node", "n", F.explode("part").alias("key"))
    # by rows: a list of one row has no partner in it
    shared = entries.groupBy("key").count().where("count > 1").select("key")
    lists = entries.join(shared, "key", "left_semi").distinct()
    need = F.expr(f"1 + ((n * {percent} + 99) div 100) div {SPARE}")
    alive = lists.groupBy("node", "n").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= need)
    lists = scratch(lists.join(alive.select("node", need.cast("int").alias("need")), "node"), "ngram-lists")
    length = lists.groupBy("key").agg(F.count(F.lit(1)).alias("len")).where("len > 1")
    w = F.row_number().over(Window.partitionBy("node").orderBy(F.col("len").desc(), F.col("key").desc()))
    return (lists.join(length, "key").withColumn("from_longest", w)
            .where(F.col("from_longest") >= F.col("need")).select("key", "node", "n", "len"))


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id (smallest
    doc_id reachable by links, itself included).

    Null, empty and blank texts have an empty set and link with nothing; a text of fewer
    than ``k`` words is one shingle. Equal texts always link. A null id is kept and never
    names a component unless all its members have none. Repeated rows give a row each. An
    empty table gives no rows. Other columns are not read. Whole texts are used.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = scratch(_sets(d, k, percent, False), "ngram-base")
    lists = scratch(_short_lists(base, percent), "ngram-short")

    # whole sets of the nodes that are left, from one document each
    nodes = scratch(lists.groupBy("node").agg(F.avg("len").alias("score")), "ngram-nodes")
    reps = scratch(base.join(nodes.select("node"), "node", "left_semi")
                   .groupBy("node").agg(F.min("doc_id").alias("doc_id")), "ngram-reps").select("doc_id").distinct()
    some = sieve(d, reps, "doc_id").join(reps.withColumnRenamed("doc_id", "rep"),
                                         F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    sets = scratch(_sets(some, k, percent, True).join(nodes.select("node"), "node", "left_semi")
                   .dropDuplicates(["node"]).select("node", "part"), "ngram-sets")

    # every node against the leader of its lists that it meets most often
    lead = lists.join(nodes, "node").groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("m"))
    led = scratch(lists.join(lead.select("key", F.col("m.node").alias("block"), F.col("m.n").alias("bn")), "key")
                  .groupBy("block", "bn", "node", "n").agg(F.count(F.lit(1)).alias("met")), "ngram-led")
    pairs = led.where((F.col("node") != F.col("block")) & _close(F.col("n"), F.col("bn"), percent)) \
        .groupBy(F.col("node").alias("a")).agg(F.max_by("block", F.struct("met", "block")).alias("b"))
    edges = scratch(verify(pairs, sets, percent), "ngram-edges")
    comps = scratch(components(edges), "ngram-comps")

    # what is not in the largest component of a block searches the block
    cl = led.select("block", "node", "n").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per = cl.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    most = per.groupBy("block").agg(F.max_by("comp", F.struct("c", "comp")).alias("largest"),
                                    F.count(F.lit(1)).alias("comps"), F.sum("s").alias("s")).where("comps > 1")
    most = most.select("block", "largest", F.ceil(F.col("s") / CHUNK_SHINGLES).cast("int").alias("pieces"))
    rows = scratch(cl.join(most, "block"), "ngram-blocks")
    piece = F.pmod(F.xxhash64("node", F.lit(3)), F.col("pieces")).cast("int")
    index = rows.select("block", piece.alias("piece"), F.lit(0).alias("query"), "node", "comp")
    query = rows.where("comp <> largest").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(1).alias("query"), "node", "comp")
    both = index.unionAll(query).join(sets, "node").select("block", "piece", "query", "node", "comp", "part") \
        .repartition("block", "piece").sortWithinPartitions("block", "piece", "query", "node")
    more = scratch(search_blocks(both, percent), "ngram-more")
    comps = components(edges.unionAll(more)) if not more.isEmpty() else comps

    # smallest document of each component, by node
    low = base.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    low = low.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    low = low.select("node", "comp", "low").join(
        low.groupBy("comp").agg(F.min("low").alias("component_id")), "comp").select("node", "component_id")
    low = low.withColumn("has", F.lit(1))
    return base.select("doc_id", "n", "node").withColumn("has", F.when(F.col("n") > 0, 1).otherwise(0)) \
        .join(low, ["node", "has"], "left") \
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
