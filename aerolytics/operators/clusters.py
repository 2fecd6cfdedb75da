"""Clustering of entity profiles.

* k-means: Lloyd's iterations for every k and seed in the same scans, until nothing moves;
  lowest cost per k, best silhouette across k.
* silhouette: squared Euclidean (MLlib's ``ClusteringEvaluator`` default). It is exact
  from per-cluster aggregates — the mean squared distance from x to cluster C is
  ``|x|^2 - 2 x.mu_C + mean_C |y|^2`` — so it costs O(n k), never pairs.
* Calinski-Harabasz from per-cluster sums.
* Density clustering: cells of mutual neighbours, boxes and a cell graph
  (:mod:`aerolytics.operators.density`), without pairs of points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolytics.operators import density
from aerolytics.operators.clean import label_encode
from aerolytics.operators.joins import null_safe_join
from aerolytics.operators.storage import sized_cache
from aerolytics.constants import (CLUSTER_DESCRIPTIONS, DBSCAN_EPS, DBSCAN_MIN_POINTS,
                                  KMEANS_K_RANGE, KMEANS_RESTARTS, SEED, UNKNOWN_CLUSTER_TEXT)
from aerolytics.session import ensure_checkpoint_dir


def with_vector(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _sqdist_to(cols, centre) -> Column:
    return sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, centre)), F.lit(0.0))


def _least(cols):
    return cols[0] if len(cols) == 1 else F.least(*cols)


def cluster_stats(points: DataFrame, cols, label: str):
    """Per-cluster count, mean vector and mean squared norm: k rows, collected (bounded by
    the number of clusters, a model parameter)."""
    x2 = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))
    rows = points.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.avg(x2).alias("_y2"),
                                     *[F.avg(c).alias(f"_mu_{i}") for i, c in enumerate(cols)]
                                     ).collect()
    return [(r[label], r["_n"], r["_y2"], [r[f"_mu_{i}"] for i in range(len(cols))]) for r in rows]


def assign_nearest(points: DataFrame, centres: DataFrame, cols, key: str,
                   centre_key: str = "cluster") -> DataFrame:
    """Nearest centre by squared Euclidean distance; ties -> smaller centre id.

    The k centres (a model parameter) become literals, so scoring is one projection with
    no join, like ``KMeansModel.transform``.
    """
    cs = centres.select(centre_key, *cols).collect()
    id_type = centres.schema[centre_key].dataType
    best = _least([F.struct(_sqdist_to(cols, [r[c] for c in cols]).alias("d"),
                            F.lit(r[centre_key]).cast(id_type).alias("id")) for r in cs])
    return points.select(key, best["id"].alias(centre_key))


def assign_profile(centres, rows: DataFrame, features, key: str, mean, std,
                   pad: bool = False) -> DataFrame:
    """Cluster assignment of raw profile rows (H20): standardise with the training
    statistics, then the nearest of the model's centres (``KMeansModel.clusterCenters()``).

    The complete profile is required; ``pad=True`` reproduces the reference's scoring,
    where absent profile columns count as 0 before scaling.
    """
    missing = [c for c in features if c not in rows.columns]
    if missing and not pad:
        raise ValueError(f"profile columns missing: {missing}")
    return rows.select(key, nearest_of(centres, rows, features, mean, std).alias("cluster"))


def nearest_of(centres, rows: DataFrame, features, mean, std) -> Column:
    """Number of the centre nearest to the standardised features; absent or NULL ones count as
    0 before scaling, ties go to the smaller number."""
    scaled = [((F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)) - F.lit(float(m)))
              / F.lit(float(s) if s else 1.0) for c, m, s in zip(features, mean, std)]
    return _least([F.struct(sum(((x - F.lit(float(v))) ** 2 for x, v in zip(scaled, c)), F.lit(0.0)).alias("d"),
                            F.lit(i).alias("id")) for i, c in enumerate(centres)])["id"]


def silhouette_sq(points: DataFrame, cols, key: str | None = None, label: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, exact from cluster aggregates:
    one aggregate for the k cluster statistics, one pass over the points."""
    stats = cluster_stats(points, cols, label)
    x2 = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))

    def mean_sq(mu, y2):  # mean squared distance from the point to all members
        return x2 - 2 * sum((F.col(c) * F.lit(float(m)) for c, m in zip(cols, mu)), F.lit(0.0)) \
            + F.lit(float(y2))

    own_n = F.lit(None).cast("long")
    a = F.lit(None).cast("double")
    others = []
    for lab, n, y2, mu in stats:
        is_own = F.col(label) == F.lit(lab)
        own_n = F.when(is_own, F.lit(n)).otherwise(own_n)
        a = F.when(is_own, mean_sq(mu, y2) * n / max(n - 1, 1)).otherwise(a)
        others.append(F.when(~is_own, mean_sq(mu, y2)))
    b = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
    denom = F.greatest(a, b)
    s = (F.when((own_n <= 1) | (denom == 0), F.lit(0.0))  # singleton or coincident points
         .otherwise((b - a) / denom))
    return points.agg(F.avg(s).alias("silhouette"))


def calinski_harabasz(points: DataFrame, cols, label: str = "cluster") -> DataFrame:
    """Between / within dispersion ratio from the k cluster statistics and one pass."""
    stats = cluster_stats(points, cols, label)
    n = sum(r[1] for r in stats)
    k = len(stats)
    if k < 2 or n <= k:                                  # not defined
        return points.agg(F.lit(None).cast("double").alias("calinski_harabasz"))
    g = [sum(r[1] * r[3][i] for r in stats) / n for i in range(len(cols))]
    between = sum(r[1] * sum((m - gi) ** 2 for m, gi in zip(r[3], g)) for r in stats)
    own = None
    for lab, _, _, mu in stats:
        d = _sqdist_to(cols, mu)
        own = F.when(F.col(label) == F.lit(lab), d) if own is None else own.when(F.col(label) == F.lit(lab), d)
    within = F.sum(own)
    return points.agg(((F.lit(between) / (k - 1)) / (within / (n - k))).alias("calinski_harabasz"))


DRIVER_NUMBERS = 100_000         # partial sums of a scan that the driver adds itself
KMEANS_TOL = 1e-4                # squared move of a centre below which a fit has settled


def _kmeans_starts(points: DataFrame, cols, specs, sample: int) -> list[np.ndarray]:
    """k-means++ centres per (k, seed) from at most ``sample`` points, drawn by a hash of the
    point (a bound, not a share: only where the iterations start depends on it)."""
    rows = points.select(*cols).orderBy(F.xxhash64(*cols), *cols).limit(sample).collect()
    x = np.array([[float(v) for v in r] for r in rows], dtype=float)
    out = []
    for k, seed in specs:
        rng = np.random.default_rng(seed)
        centres = [x[rng.integers(len(x))]]
        d = ((x - centres[0]) ** 2).sum(axis=1)
        while len(centres) < k:
            total = d.sum()
            centres.append(x[rng.choice(len(x), p=d / total) if total > 0 else rng.integers(len(x))])
            d = np.minimum(d, ((x - centres[-1]) ** 2).sum(axis=1))
        out.append(np.array(centres))
    return out


def _lloyd_scan(points: DataFrame, cols, centre_sets: list[np.ndarray], tasks: int | None = None):
    """One scan for all centre sets: (sums, counts, cost) of each. Tasks leave one number per
    centre and dimension; these are added by one aggregate and are all that is collected. The
    numbers of a few known ``tasks`` are added by the driver instead, which saves the shuffle."""
    d = len(cols)
    size = sum(len(c) for c in centre_sets) * (d + 2)

    def partial(batches):
        total = [np.zeros((len(c), d + 2)) for c in centre_sets]
        for batch in batches:
            x = np.stack([col.to_numpy(zero_copy_only=False).astype(float) for col in batch.columns], axis=1)
            for lo in range(0, len(x), 8192):
                part = x[lo:lo + 8192]
                for c, t in zip(centre_sets, total):
                    gap = np.stack([((part - m) ** 2).sum(axis=1) for m in c], axis=1)
                    at = gap.argmin(axis=1)
                    for j in range(d):
                        t[:, j] += np.bincount(at, part[:, j], len(c))
                    t[:, d] += np.bincount(at, minlength=len(c))
                    t[:, d + 1] += np.bincount(at, gap[np.arange(len(part)), at], len(c))
        flat = np.concatenate([t.ravel() for t in total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "v"])

    parts = points.mapInArrow(partial, "i long, v double")
    if tasks is None or tasks * size > DRIVER_NUMBERS:
        parts = parts.groupBy("i").agg(F.sum("v").alias("v"))
    sums = parts.toArrow()
    flat = np.bincount(sums.column("i").to_numpy(), sums.column("v").to_numpy(), size)
    out, at = [], 0
    for c in centre_sets:
        t = flat[at:at + len(c) * (d + 2)].reshape(len(c), d + 2)
        at += t.size
        out.append((t[:, :d], t[:, d], float(t[:, d + 1].sum())))
    return out


def kmeans_fit(points: DataFrame, cols, specs, max_iter: int = 300, tol: float = KMEANS_TOL,
               sample: int = 4096, tasks: int | None = None) -> list[tuple[np.ndarray, float]]:
    """Lloyd's iterations for all (k, seed) at once: every scan moves the centres of all fits
    that still move by more than ``tol`` (squared). Returns (centres, cost) per fit; an empty
    cluster keeps its centre. Fits that do not settle within ``max_iter`` scans are an error."""
    data = points.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in cols])
    centres = _kmeans_starts(data, cols, specs, sample)
    cost = [0.0] * len(specs)
    moving = list(range(len(specs)))
    for _ in range(max_iter):
        still = []
        for i, (sums, counts, c) in zip(moving, _lloyd_scan(data, cols, [centres[i] for i in moving], tasks)):
            new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres[i])
            gone = ((new - centres[i]) ** 2).sum(axis=1).max()
            cost[i] = c
            if gone > tol:
                centres[i] = new
                still.append(i)
        moving = still
        if not moving:
            return list(zip(centres, cost))
    raise RuntimeError(f"{len(moving)} fits still move after {max_iter} scans")


class Centres:
    """A chosen k-means model: its centres, in standardised columns."""

    def __init__(self, cols, centres: np.ndarray):
        self.cols, self.centres = list(cols), centres

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def cluster(self, df: DataFrame) -> Column:
        return nearest_of(self.centres, df, self.cols, [0.0] * len(self.cols), [1.0] * len(self.cols))


def kmeans_select(points: DataFrame, cols, k_range=KMEANS_K_RANGE,
                  restarts: int = KMEANS_RESTARTS, seed: int = SEED, max_iter: int = 300):
    """k-means over ``k_range`` x ``restarts`` seeds, all in the same scans: lowest cost per k,
    best squared silhouette across k (ties -> smaller k). Returns (model, k, silhouette, table
    of (k, silhouette)); too few points for a silhouette give the smallest k that fits."""
    data = sized_cache(points.select(*cols))             # read by every scan
    n = data.count()
    if not n:
        raise ValueError("no points to cluster")
    ks = [k for k in k_range if 2 <= k <= n - 1]
    specs = [(k, seed + r) for k in ks or [max(1, min(k_range[0], n))] for r in range(restarts)]
    fits = kmeans_fit(data, cols, specs, max_iter, tasks=data.rdd.getNumPartitions())
    best, scores = None, []
    for k in dict.fromkeys(k for k, _ in specs):
        centres, _ = min((f for (kk, _), f in zip(specs, fits) if kk == k), key=lambda f: f[1])
        model = Centres(cols, centres)
        labelled = data.withColumn("cluster", model.cluster(data))
        s = silhouette_sq(labelled, cols, None).first()["silhouette"] if ks else None
        if s is not None:
            scores.append((k, s))
        if best is None or (s is not None and s > best[2]):
            best = (model, k, -1.0 if s is None else s)
    data.unpersist()
    return best[0], best[1], best[2], scores


def kmeans_labels(model, points: DataFrame, cols, key: str) -> DataFrame:
    return points.select(key, model.cluster(points).alias("cluster_kmeans"))


def describe_clusters(labels: DataFrame, profile: DataFrame, key: str, label: str,
                      rank_by: str) -> DataFrame:
    """Cluster text tied to the cluster's rank by mean ``rank_by`` (cleanest first)."""
    texts = F.array(*[F.lit(t) for t in CLUSTER_DESCRIPTIONS])
    means = (null_safe_join(labels, profile.select(key, rank_by), [key])
             .groupBy(label).agg(F.avg(rank_by).alias("_m")))
    # one row per cluster (k rows): a global window over k rows is bounded
    ranked = means.select(label, (F.dense_rank().over(Window.orderBy("_m")) - 1).alias("_r"))
    return ranked.select(label, F.coalesce(
        F.when(F.col("_r") < len(CLUSTER_DESCRIPTIONS), F.element_at(texts, F.col("_r") + 1)),
        F.lit(UNKNOWN_CLUSTER_TEXT)).alias("description"))


# --- density clustering ------------------------------------------------------------

def dbscan_neighbours(points: DataFrame, cols, key: str, eps: float = DBSCAN_EPS,
                      min_points: int = DBSCAN_MIN_POINTS, grid_dims: int | None = None) -> DataFrame:
    """Points within ``eps`` of each point (itself included) and whether it is a core point."""
    ensure_checkpoint_dir(points.sparkSession)
    counts = density.neighbour_counts(points, cols, key, eps, grid_dims)
    return counts.select(F.col("id").alias(key), "n_neighbours",
                         (F.col("n_neighbours") >= min_points).alias("is_core"))


def dbscan(points: DataFrame, cols, key: str, eps: float = DBSCAN_EPS,
           min_points: int = DBSCAN_MIN_POINTS, grid_dims: int | None = None,
           max_rounds: int | None = None) -> DataFrame:
    """DBSCAN labels: cluster = smallest key of its connected core component (integer keys;
    other keys: the rank of that key among the clusters, from 0); border points take the
    smallest adjacent cluster; noise = -1. Labels spread until nothing changes;
    ``max_rounds`` makes an unfinished spread an error. See :mod:`aerolytics.operators.density`."""
    ensure_checkpoint_dir(points.sparkSession)
    labels = density.density_labels(points, cols, key, eps, min_points, grid_dims, max_rounds)
    if not isinstance(points.schema[key].dataType, T.IntegralType):
        # clusters are ranked like label codes: by ranges, never all in one task
        labels = label_encode(labels, "label", "rank").select("id", F.col("rank").alias("label"))
    labels = labels.select(F.col("id").alias("_node"), "label")
    out = points.select(key).join(labels, F.col(key).eqNullSafe(F.col("_node")), "left")
    return out.select(key, F.coalesce(F.col("label").cast("long"), F.lit(-1).cast("long")).alias("cluster_dbscan"))


def vector_columns(df: DataFrame, vec: str, names) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)])


def to_vector(df: DataFrame, arr_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr_col)))
