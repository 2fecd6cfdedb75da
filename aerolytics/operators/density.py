"""Density clustering by cells, and by chunks of points that are compared in pairs inside tasks.

Points are dealt into cells of side ``eps / sqrt(d)``: all points of one cell are mutual
neighbours. A cell with ``min_points`` points consists of core points; only the fewer
points of the other cells are counted. What Spark joins are *chunks*: the points are cut by
quantiles of their first dimensions into parts of about ``chunk_rows``, and every two chunks
whose bounding boxes are within ``eps`` are one group of a cogroup. A task holds one group at a
time. Inside it each side is a tree of boxes, halved at the median of the widest dimension:

* the greatest distance between two boxes is within ``eps``: all pairs of theirs are;
* the least distance is beyond ``eps``: none is;
* else the larger box is halved; the points of two leaves are compared as arrays.

What leaves a group are counts, links of cells (a spanning forest) or smallest labels, never
pairs of points. Gaps and reaches of boxes are sums of the same differences, in the same order,
as the distances of points; rounding is monotone, so a decision by boxes never differs from the
comparison of the points. Clusters are the connected components of the graph of cells that
hold core points. Points with a null or non-finite coordinate have no neighbours.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.operators.clean import label_encode
from aerolytics.operators.storage import stored

MARGIN = 1e-6                    # cells are smaller by this share, so that rounding cannot lift a diagonal over eps
SALT_ROWS = 10_000               # points of one part (equal ones cannot be cut) that a chunk holds at least
CHUNK_ROWS = 4096
MOST_CHUNK_ROWS = 32_768
CHUNKS = 64                      # up to so many chunks a chunk does not grow with the points
CUT_DIMS = 4


def _comparer(what: str, d: int, eps2: float):
    """The function of a group: ``counts``, ``links`` or ``labels`` of its left points; defined
    inside, so that it is sent by value."""
    import numpy as np
    import pyarrow as pa

    leaf, batch = 64, 64

    class Tree:
        """Points in the order of their leaves, and the boxes of all nodes."""

        def __init__(self, x):
            self.order = np.arange(len(x))
            start, end, child, depth = [0], [len(x)], [], []
            lo, hi = [], []
            i = 0
            while i < len(start):
                s, e = start[i], end[i]
                part = x[self.order[s:e]]
                a, b = part.min(axis=0), part.max(axis=0)
                lo.append(a)
                hi.append(b)
                if e - s > leaf:
                    mid = (e - s) // 2
                    self.order[s:e] = self.order[s:e][np.argpartition(part[:, (b - a).argmax()], mid)]
                    child.append(len(start))
                    start += [s, s + mid]
                    end += [s + mid, e]
                else:
                    child.append(-1)
                i += 1
            self.x = x[self.order]
            self.start, self.end, self.child = np.array(start), np.array(end), np.array(child)
            self.lo, self.hi = np.array(lo), np.array(hi)
            self.n = self.end - self.start

        def rows(self, nodes):
            """Rows of each leaf, padded; and which are real."""
            at = self.start[nodes][:, None] + np.arange(leaf)[None, :]
            real = at < self.end[nodes][:, None]
            return np.where(real, at, 0), real

    def decided(a, b):
        """Pairs of nodes that are within reach as a whole, and pairs of leaves to compare."""
        ia, ib = np.zeros(1, np.int64), np.zeros(1, np.int64)
        inside, leaves = [], []
        while len(ia):
            gap, reach = np.zeros(len(ia)), np.zeros(len(ia))
            for k in range(d):
                g = np.maximum(np.maximum(b.lo[ib, k] - a.hi[ia, k], a.lo[ia, k] - b.hi[ib, k]), 0.0)
                r = np.maximum(b.hi[ib, k] - a.lo[ia, k], a.hi[ia, k] - b.lo[ib, k])
                gap += g * g
                reach += r * r
            whole = reach <= eps2
            inside.append((ia[whole], ib[whole]))
            left = (gap <= eps2) & ~whole
            ia, ib = ia[left], ib[left]
            last = (a.child[ia] < 0) & (b.child[ib] < 0)
            leaves.append((ia[last], ib[last]))
            ia, ib = ia[~last], ib[~last]
            first = (b.child[ib] < 0) | ((a.child[ia] >= 0) & (a.n[ia] >= b.n[ib]))
            ca, cb = a.child[ia[first]], b.child[ib[~first]]
            ia, ib = (np.concatenate([ca, ca + 1, ia[~first], ia[~first]]),
                      np.concatenate([ib[first], ib[first], cb, cb + 1]))
        return [tuple(np.concatenate(x) for x in zip(*found)) for found in (inside, leaves)]

    def near(a, b, na, nb):
        """Which points of pairs of leaves are within eps, with their rows."""
        ra, va = a.rows(na)
        rb, vb = b.rows(nb)
        dist = np.zeros((len(na), leaf, leaf))
        for k in range(d):
            g = a.x[ra, k][:, :, None] - b.x[rb, k][:, None, :]
            g *= g
            dist += g
        return ra, rb, (dist <= eps2) & va[:, :, None] & vb[:, None, :]

    def batches(pairs):
        for lo in range(0, len(pairs[0]), batch):
            yield pairs[0][lo:lo + batch], pairs[1][lo:lo + batch]

    def counts(a, b, *_):
        inside, leaves = decided(a, b)
        out = np.zeros(len(a.x), np.int64)
        per_node = np.bincount(inside[0], b.n[inside[1]], len(a.n)).astype(np.int64)
        for i in np.flatnonzero(per_node):
            out[a.start[i]:a.end[i]] += per_node[i]
        for na, nb in batches(leaves):
            ra, _, hit = near(a, b, na, nb)
            np.add.at(out, ra, hit.sum(axis=2))
        return out

    def labels(a, b, code_a, code_b):
        """Smallest code of ``b`` within eps of each point of ``a``, -1 for none."""
        inside, leaves = decided(a, b)
        most = np.int64(np.iinfo(np.int64).max)
        out = np.full(len(a.x), most)
        for i, j in zip(*inside):
            part = out[a.start[i]:a.end[i]]
            np.minimum(part, code_b[b.start[j]:b.end[j]].min(), out=part)
        for na, nb in batches(leaves):
            ra, rb, hit = near(a, b, na, nb)
            np.minimum.at(out, ra, np.where(hit, code_b[rb][:, None, :], most).min(axis=2))
        return np.where(out == most, -1, out)

    def links(a, b, code_a, code_b):
        """Links of cells that join what was not joined: a spanning forest of the group."""
        cells, at = np.unique(np.concatenate([code_a, code_b]), return_inverse=True)
        cell_a, cell_b = at[:len(code_a)], at[len(code_a):]
        parent = np.arange(len(cells))
        forest = []

        def top(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def join(pairs):
            for i, j in pairs:
                p, q = top(i), top(j)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    forest.append((cells[i], cells[j]))

        def one(root, of, t, nodes):
            """The component of all points of a leaf, -1 if there are several."""
            rows, real = t.rows(nodes)
            c = root[of[rows]]
            return np.where(((c == c[:, :1]) | ~real).all(axis=1), c[:, 0], -1)

        def roots():
            return np.array([top(i) for i in range(len(parent))])

        inside, leaves = decided(a, b)
        for i, j in zip(*inside):
            pa_, pb_ = cell_a[a.start[i]:a.end[i]], cell_b[b.start[j]:b.end[j]]
            join((pa_[0], k) for k in np.unique(pb_))
            join((k, pb_[0]) for k in np.unique(pa_))
        root = roots()
        for lo in range(0, len(leaves[0]), 16 * batch):
            na, nb = leaves[0][lo:lo + 16 * batch], leaves[1][lo:lo + 16 * batch]
            ca, cb = one(root, cell_a, a, na), one(root, cell_b, b, nb)
            todo = (ca < 0) | (ca != cb)
            joined = len(forest)
            for ma, mb in batches((na[todo], nb[todo])):
                ra, rb, hit = near(a, b, ma, mb)
                i, j, k = np.nonzero(hit)
                met = np.unique(cell_a[ra[i, j]] * len(cells) + cell_b[rb[i, k]])
                p, q = met // len(cells), met % len(cells)
                new = root[p] != root[q]
                join(zip(p[new], q[new]))
            if len(forest) > joined:
                root = roots()
        return forest

    def side(t):
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        return Tree(x), t.column("row").to_numpy(), t.column("code").to_numpy().astype(np.int64)

    def group(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        (a, row, code_a), (b, _, code_b) = side(left), side(right)
        code_a, code_b, row = code_a[a.order], code_b[b.order], row[a.order]
        if what == "links":
            found = links(a, b, code_a, code_b)
            return pa.table({"row": pa.array([int(i) for i, _ in found], pa.int64()),
                             "v": pa.array([int(j) for _, j in found], pa.int64())})
        v = (counts if what == "counts" else labels)(a, b, code_a, code_b)
        some = v > 0 if what == "counts" else v >= 0
        return pa.table({"row": pa.array(row[some], pa.int64()), "v": pa.array(v[some], pa.int64())})

    return group


def _chunks(points: DataFrame, n: int, d: int, dims: int | None, chunk_rows: int) -> DataFrame:
    """``points`` with ``part``: cut by quantiles of one dimension after the other. A part with
    many equal points, which no quantile cuts, is dealt into chunks later."""
    points = points.withColumn("part", F.lit(0).cast("long"))
    if n <= chunk_rows:
        return points
    dims = min(d, dims or CUT_DIMS)
    cuts = math.ceil((n / chunk_rows) ** (1 / dims))
    for i in range(dims):
        at = F.percentile_approx(F.col("x")[i], [k / cuts for k in range(1, cuts)], 1000)
        q = points.groupBy("part").agg(at.alias("q"))
        place = F.size(F.filter("q", lambda v: v < F.col("x")[i])).cast("long")
        points = points.join(F.broadcast(q), "part").withColumn("part", F.col("part") * cuts + place).drop("q")
    return points


class Cells:
    """The points in their cells and chunks."""

    def __init__(self, points: DataFrame, cols, key: str, eps: float, grid_dims: int | None = None,
                 budget: int | None = None):
        self.d, self.eps2 = len(cols), eps * eps
        self.spark = points.sparkSession
        side = eps / math.sqrt(self.d) * (1 - MARGIN)
        x = [F.col(f"`{c}`").cast("double") for c in cols]
        real = F.lit(True)
        for c in x:
            real = real & c.isNotNull() & (F.abs(c) < float("inf"))
        placed = points.where(real).select(F.col(f"`{key}`").alias("id"), F.array(*x).alias("x"))
        placed = stored(placed.withColumn("cell", F.array(*[F.floor(F.col("x")[i] / side) for i in range(self.d)]))
                        .withColumn("row", F.monotonically_increasing_id()), "cells")
        self.n = placed.count()
        self.boxes = stored(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
                            .withColumn("code", F.monotonically_increasing_id()), "cell-boxes")
        self.chunk_rows = budget or min(max(CHUNK_ROWS, self.n // CHUNKS), MOST_CHUNK_ROWS)
        parts = stored(_chunks(placed.join(self.boxes.select("cell", "code", F.col("n").alias("own")), "cell").drop("cell"),
                               self.n, self.d, grid_dims, self.chunk_rows), "parts")
        most = max(SALT_ROWS, 2 * self.chunk_rows)
        sizes = parts.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / most).alias("salts"))
        salt = F.pmod(F.xxhash64("row"), F.col("salts"))
        self.points = parts.join(F.broadcast(sizes), "part").withColumn("salt", salt).drop("salts")
        lo = F.array(*[F.min(F.col("x")[i]) for i in range(self.d)])
        hi = F.array(*[F.max(F.col("x")[i]) for i in range(self.d)])
        self.chunks = stored(self.points.groupBy("part", "salt").agg(lo.alias("lo"), hi.alias("hi")), "chunks")

    @functools.cached_property
    def near(self) -> DataFrame:
        """Links of neighbouring cells, of all points."""
        return self.links(self.points)

    def compared(self, what: str, left: DataFrame, right: DataFrame, once: bool = False) -> DataFrame:
        """``row`` and ``v`` of the groups of points (part, salt, row, x, code) whose chunks are
        within eps; ``once``: a pair of chunks in one order only."""
        a, b = (self.chunks.select(F.struct("part", "salt").alias(s), F.col("lo").alias(f"{s}_lo"), F.col("hi").alias(f"{s}_hi"))
                for s in "ab")
        gap = F.lit(0.0)
        for i in range(self.d):
            g = F.greatest(F.col("b_lo")[i] - F.col("a_hi")[i], F.col("a_lo")[i] - F.col("b_hi")[i], F.lit(0.0))
            gap = gap + g * g
        pairs = stored(a.crossJoin(b).where((gap <= self.eps2) & ((F.col("a") <= F.col("b")) if once else F.lit(True)))
                       .select("a", "b"), "chunk-pairs")
        # the groups are few bytes and much work: as many tasks as there are cores or pairs
        tasks = max(1, min(pairs.count(), 4 * self.spark.sparkContext.defaultParallelism + 1))

        def sent(points, s):
            p = points.select(F.struct("part", "salt").alias(s), "row", "x", "code").join(pairs, s)
            p = p.select(*[F.col(c).alias(c) for c in ("a", "b", "row", "x", "code")])      # both sides hold the pairs
            return p.repartition(tasks, "a", "b").groupBy("a", "b")

        return sent(left, "a").cogroup(sent(right, "b")).applyInArrow(_comparer(what, self.d, self.eps2), "row long, v long")

    def counts(self, below: int | None = None) -> DataFrame:
        """For the points of cells of fewer than ``below`` points: ``near``, the number of points
        of other cells within eps."""
        probes = self.points if below is None else self.points.where(F.col("own") < below)
        found = self.compared("counts", probes, self.points).groupBy("row").agg(F.sum("v").alias("v"))
        return found.join(probes.select("row", "own"), "row").select("row", (F.col("v") - F.col("own")).alias("near")).where("near > 0")

    def links(self, core: DataFrame) -> DataFrame:
        """Pairs of cells with two core points within eps that join all components."""
        return self.compared("links", core, core, once=True).select(F.col("row").alias("a"), F.col("v").alias("b")).distinct()


def neighbour_counts(points: DataFrame, cols, key: str, eps: float, grid_dims: int | None = None,
                     budget: int | None = None) -> DataFrame:
    """``id`` and ``n_neighbours``: points within ``eps``, itself included."""
    cells = Cells(points, cols, key, eps, grid_dims, budget)
    return cells.points.join(cells.counts(), "row", "left").select(
        "id", (F.col("own") + F.coalesce("near", F.lit(0))).alias("n_neighbours"))


def smallest_labels(nodes: DataFrame, edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component; ``edges`` (a, b) in both
    directions. Every round takes the smallest label around and then that label's label
    (pointer jumping), in a stored table, until nothing changes."""
    labels = nodes.select("node", F.col("node").alias("label"))
    for done in itertools.count():
        if max_rounds is not None and done >= max_rounds:
            raise RuntimeError(f"labels still change after {max_rounds} rounds")
        around = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("other")))
        step = labels.join(around, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("other", "label")).alias("l1"))
        jump = step.select(F.col("node").alias("l1"), F.col("l1").alias("l2"))
        new = stored(step.join(jump, "l1", "left").select(
            "node", "old", F.least("l1", F.coalesce("l2", "l1")).alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def density_labels(points: DataFrame, cols, key: str, eps: float, min_points: int, grid_dims: int | None = None,
                   max_rounds: int | None = None, budget: int | None = None) -> DataFrame:
    """``id`` and ``label`` of the points in clusters: the smallest key among the core points of
    the cluster; a border point takes the smallest label within ``eps``. Noise is left out."""
    cells = Cells(points, cols, key, eps, grid_dims, budget)
    sure = cells.points.where(F.col("own") >= min_points).withColumn("core", F.lit(True))
    sparse = cells.points.where(F.col("own") < min_points).join(cells.counts(min_points), "row", "left")
    sparse = sparse.withColumn("core", F.col("own") + F.coalesce("near", F.lit(0)) >= min_points).drop("near")
    every = stored(sure.unionByName(sparse), "core-points")
    core, other = every.where("core"), every.where("not core")
    # a cell whose core points all lack a key has no label and joins nothing
    nodes = stored(core.groupBy("code").agg(F.min("id").alias("first")).where(F.col("first").isNotNull()), "core-cells")
    core = core.join(nodes.select("code"), "code", "left_semi")
    links = cells.links(core)
    edges = stored(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cell-links")
    joined = smallest_labels(nodes.select(F.col("code").alias("node")), edges, max_rounds)
    clusters = joined.join(nodes, F.col("node") == F.col("code")).select("code", F.col("label").alias("cluster"), "first")
    names = clusters.groupBy("cluster").agg(F.min("first").alias("label"))
    label = stored(clusters.join(names, "cluster").select("code", "label"), "cell-labels")
    # points beside the core: the place of the label in the order of all labels is what is compared
    place = stored(label_encode(label, "label", "place"), "label-places")
    marked = core.join(place, "code").drop("code").withColumnRenamed("place", "code")
    border = cells.compared("labels", other, marked).groupBy("row").agg(F.min("v").alias("place"))
    border = border.join(place.select("place", "label").distinct(), "place").join(other.select("row", "id"), "row")
    return core.join(label, "code").select("id", "label").unionAll(border.select("id", "label"))
