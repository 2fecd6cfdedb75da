"""k-means in shared scans: a fixpoint, not costlier than MLlib's best, odd tables."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from aerolytics.operators import clean, clusters


def _blobs(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    at = rng.integers(0, 4, n)
    x = np.array([[0, 0, 0], [4, 0, 1], [0, 5, 2], [6, 6, 0]])[at] + rng.normal(size=(n, 3)) * 0.9
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double"), x


def test_not_costlier_than_mllib(spark):
    df, x = _blobs(spark)
    cols = ["a", "b", "c"]
    fits = clusters.kmeans_fit(df, cols, [(k, 42 + r) for k in (3, 4) for r in range(10)], tol=1e-12)
    data = clusters.with_vector(df, cols).cache()
    for k, part in ((3, fits[:10]), (4, fits[10:])):
        centres, cost = min(part, key=lambda f: f[1])
        d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        assert cost == pytest.approx(d.min(axis=1).sum())
        means = np.array([x[d.argmin(axis=1) == i].mean(axis=0) for i in range(k)])
        assert np.allclose(means, centres, atol=1e-5)
        ml = min(KMeans(k=k, seed=42 + r, featuresCol="features").fit(data).summary.trainingCost for r in range(3))
        assert cost <= ml * (1 + 1e-9)
    data.unpersist()


def test_choice_labels_and_small_tables(spark):
    df, x = _blobs(spark)
    cols = ["a", "b", "c"]
    model, k, sil, scores = clusters.kmeans_select(df, cols, restarts=4)
    assert k == 4 and dict(scores)[4] == sil and [s[0] for s in scores] == [3, 4, 5]
    got = dict(clusters.kmeans_labels(model, df, cols, "id").collect())
    d = ((x[:, None] - np.array(model.clusterCenters())[None]) ** 2).sum(axis=2)
    assert [got[i] for i in range(len(x))] == d.argmin(axis=1).tolist()
    two, k, sil, _ = clusters.kmeans_select(df.limit(2), cols, restarts=2)
    assert (k, sil) == (2, -1.0) and len(two.clusterCenters()) == 2
    same = spark.createDataFrame([(i, 1.0, None) for i in range(9)], "id int, a double, b double")
    assert clusters.kmeans_fit(same, ["a", "b"], [(3, 1)])[0][1] == 0.0
    with pytest.raises(ValueError):
        clusters.kmeans_select(df.limit(0), cols)


def test_null_station_keeps_its_median_in_both_forms(spark):
    rows = [(i, None if i % 3 == 0 else "s", i, None if i in (0, 1) else float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, station string, t int, v double") \
        .withColumn("datetime", F.timestamp_add("HOUR", F.col("t"), F.lit("2024-01-01").cast("timestamp_ntz")))
    forms = [clean.impute_ffill_median(df, ["v"], mode="plain"), clean.impute_ffill_median(df, ["v"], mode="chunked", chunk_rows=5),
             clean.impute_ffill_median(df, ["v"], max_distinct=1)]
    first, *others = [sorted((r["id"], r["v"]) for r in f.collect()) for f in forms]
    assert first[0] == (0, 15.0) and all(v is not None for _, v in first) and all(o == first for o in others)
