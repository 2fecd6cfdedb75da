"""Registered queries: model input, learners, scoring, clustering, projection (H1-H13, H18-H20,
A6-A7). Fitted models are rows-only checks (no SQL); their SQL-expressible stages —
assembled inputs, assignments, silhouette, dispersion, neighbours, components,
covariance — have DuckDB oracles (some by brute force on the small profile table)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from aerolytics.constants import CLASSIFIER_FEATURES, REGRESSOR_FEATURES
from aerolytics.operators import clusters, models, projection, sampling
from aerolytics.operators.clean import scale_standard
from aerolytics.operators.profiles import station_profile
from aerolytics.plans.feature_queries import (PM25_LAGS, ROLLING_WINDOWS, READINGS_USER,
                                              features_by_user, sql_calendar, sql_code,
                                              sql_lags, sql_rolling)
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.operators.storage import sized_cache, stored
from aerolytics.session import ensure_checkpoint_dir
from aerolytics.sources.tables import table

# small settings for the registered checks; the functions default to the full values
SMALL = dict(rf_trees=20, rf_depth=6, gbt_rounds=5, gbt_depth=3)
#: rows of a cached partition: each round of a tree learner is a pass over them, shared by all cores
TREE_ROWS = 200_000
SMALL_REG = dict(rf_trees=20, rf_depth=6, gbt_rounds=10, gbt_depth=3)

# --- H1 model input ------------------------------------------------------------------

_FEATS_SQL = f"""
SELECT * FROM (
SELECT event_id, station, datetime, pm25,
  {sql_calendar('datetime')},
  {sql_lags('pm25', PM25_LAGS, 'station', 'datetime')},
  {sql_rolling('pm25', ROLLING_WINDOWS, 'station', 'datetime')},
  {sql_code('pm25')} AS aqi_label
FROM ({READINGS_USER}) r) f
WHERE pm25_lag1 IS NOT NULL AND pm25_lag24 IS NOT NULL
"""
_CLS_AVAILABLE = [c for c in CLASSIFIER_FEATURES
                  if c in {"hour_sin", "hour_cos", "month_sin", "month_cos"}
                  or c.startswith("pm25_")]


@register("model_input", oracle=f"""
SELECT event_id, aqi_label, {', '.join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _CLS_AVAILABLE)}
FROM ({_FEATS_SQL}) f
""")
def q_model_input(spark, sf_dir):
    """Classifier input: the wanted features that exist, NULL -> 0, plus the label."""
    feats = features_by_user(spark, sf_dir)
    out, _ = models.model_input(feats, CLASSIFIER_FEATURES, "aqi_label", keep=["event_id"])
    return round_doubles(out)


def _split_features(spark, sf_dir):
    feats = features_by_user(spark, sf_dir)
    return sampling.split_time(feats, "station", "datetime", 0.2)


@register("train_classify")
def q_train_classify(spark, sf_dir):
    """Random forest and one-vs-rest boosted trees on a time split, both at full settings;
    metrics as model_runs."""
    ensure_checkpoint_dir(spark)                         # boosting cuts its lineage there every 10 rounds
    data = _split_features(spark, sf_dir)
    inp, feats = models.model_input(data, CLASSIFIER_FEATURES, "aqi_label", keep=["is_test"])
    inp = sized_cache(inp, TREE_ROWS)
    _, runs = models.train_classifiers(inp.filter(~F.col("is_test")), inp.filter(F.col("is_test")),
                                       feats, "aqi_label")
    return runs


@register("train_regress")
def q_train_regress(spark, sf_dir):
    """Gradient boosting, random forest (all features per split) and ridge on a time split."""
    data = _split_features(spark, sf_dir)
    inp, feats = models.model_input(data, [c for c in REGRESSOR_FEATURES if c != "pm25"],
                                    "pm25", keep=["is_test"])
    inp = sized_cache(inp, TREE_ROWS)
    _, runs = models.train_regressors(inp.filter(~F.col("is_test")), inp.filter(F.col("is_test")),
                                      feats, "pm25", **SMALL_REG)
    return runs


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Ridge fitted on the training side scores the test side as an uploaded batch that
    carries only some feature columns (the rest are padded with 0 in model order)."""
    data = _split_features(spark, sf_dir)
    wanted = [c for c in REGRESSOR_FEATURES if c != "pm25"]
    inp, feats = models.model_input(data, wanted, "pm25", keep=["event_id", "is_test"])
    inp = stored(inp, "score-input")                     # the feature windows run once
    train = inp.filter(~F.col("is_test"))
    reg = models.ridge_reg_param(train, "pm25")
    model = models.make_pipeline(feats, models.regressors("pm25", reg)[2][1]).fit(train)
    batch = inp.filter(F.col("is_test")).select("event_id", "pm25_lag1", "pm25_lag3", "hour_sin")
    return models.score_regression(model, batch, feats, keep=["event_id"])


@register("score_classify")
def q_score_classify(spark, sf_dir):
    data = _split_features(spark, sf_dir)
    inp, feats = models.model_input(data, CLASSIFIER_FEATURES, "aqi_label", keep=["event_id", "is_test"])
    inp = stored(inp, "score-input")
    est = models.classifiers("aqi_label", **SMALL)[0][1]
    model = models.make_pipeline(feats, est).fit(inp.filter(~F.col("is_test")))
    return models.score_classification(model, inp.filter(F.col("is_test")), feats, keep=["event_id"])


# --- clustering on supplier profiles -------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROFILE_COLS = [f"{m}_{s}" for m in _MEASURES for s in ("mean", "std", "max")]
MEAN_COLS = [f"{m}_mean" for m in _MEASURES]


def scaled_profile(spark, sf_dir, cols=PROFILE_COLS):
    """Standardised per-supplier profile. One row per entity, so it is cached: the
    multi-pass cluster statistics then read it instead of re-scanning the fact table."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), *_MEASURES)
    prof = station_profile(li, "station", _MEASURES).select("station", *cols)
    return sized_cache(scale_standard(prof, list(cols)))


def _profile_sql(cols) -> str:
    aggs = ", ".join(f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std, max({m}) AS {m}_max"
                     for m in _MEASURES)
    z = ", ".join(
        f"(coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / CASE WHEN stddev_pop(coalesce({c}, 0)) OVER () = 0 "
        f"THEN 1 ELSE stddev_pop(coalesce({c}, 0)) OVER () END AS {c}" for c in cols)
    return f"SELECT station, {z} FROM (SELECT l_suppkey AS station, {aggs} FROM lineitem GROUP BY 1) p"


def _sq(cols, a="a", b="b") -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


@register("kmeans_assign", oracle=f"""
WITH z AS ({_profile_sql(PROFILE_COLS)}),
c AS (SELECT station % 3 AS cluster, {', '.join(f'avg({c}) AS {c}' for c in PROFILE_COLS)} FROM z GROUP BY 1),
d AS (SELECT a.station, b.cluster, {_sq(PROFILE_COLS)} AS d FROM z a CROSS JOIN c b)
SELECT station, arg_min(cluster, (d, cluster)) AS cluster FROM d GROUP BY station
""")
def q_kmeans_assign(spark, sf_dir):
    """Nearest given centre: centres are the scaled profile means of ``l_suppkey % 3``."""
    z = scaled_profile(spark, sf_dir)
    centres = (z.withColumn("cluster", F.col("station") % 3).groupBy("cluster")
               .agg(*[F.avg(c).alias(c) for c in PROFILE_COLS]))
    return clusters.assign_nearest(z, centres, PROFILE_COLS, "station")


@register("silhouette", oracle=f"""
WITH z AS (SELECT *, station % 3 AS lbl FROM ({_profile_sql(PROFILE_COLS)}) q),
d AS (SELECT a.station AS s, a.lbl AS la, b.lbl AS lb, {_sq(PROFILE_COLS)} AS d FROM z a JOIN z b ON a.station <> b.station),
per AS (SELECT s, la, lb, avg(d) AS m FROM d GROUP BY ALL),
ab AS (SELECT s, la, max(CASE WHEN la = lb THEN m END) AS a, min(CASE WHEN la <> lb THEN m END) AS b FROM per GROUP BY s, la),
n AS (SELECT lbl, count(*) AS n FROM z GROUP BY 1)
SELECT {R6('avg(CASE WHEN n <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette
FROM ab JOIN n ON la = lbl
""")
def q_silhouette(spark, sf_dir):
    """Squared-Euclidean silhouette of labels ``l_suppkey % 3`` (oracle: brute-force pairs)."""
    z = scaled_profile(spark, sf_dir).withColumn("cluster", F.col("station") % 3)
    return round_doubles(clusters.silhouette_sq(z, PROFILE_COLS, "station", "cluster"))


@register("calinski_harabasz", oracle=f"""
WITH z AS (SELECT *, station % 3 AS lbl FROM ({_profile_sql(PROFILE_COLS)}) q),
g AS (SELECT count(*) AS n, {', '.join(f'avg({c}) AS g_{c}' for c in PROFILE_COLS)} FROM z),
m AS (SELECT lbl, count(*) AS n_c, {', '.join(f'avg({c}) AS m_{c}' for c in PROFILE_COLS)} FROM z GROUP BY 1),
bw AS (SELECT sum(n_c * ({' + '.join(f'(m_{c} - g_{c}) * (m_{c} - g_{c})' for c in PROFILE_COLS)})) AS bb FROM m CROSS JOIN g),
ww AS (SELECT sum({' + '.join(f'({c} - m_{c}) * ({c} - m_{c})' for c in PROFILE_COLS)}) AS wt FROM z JOIN m USING (lbl)),
k AS (SELECT count(*) AS k FROM m)
SELECT {R6('(bb / (k - 1)) / (wt / (n - k))')} AS calinski_harabasz FROM bw, ww, g, k
""")
def q_calinski_harabasz(spark, sf_dir):
    z = scaled_profile(spark, sf_dir).withColumn("cluster", F.col("station") % 3)
    return round_doubles(clusters.calinski_harabasz(z, PROFILE_COLS, "cluster"))


_EPS2 = repr(0.8 * 0.8)
_PAIRS = f"""pairs AS (SELECT a.station AS a, b.station AS b FROM z a JOIN z b
  ON {_sq(MEAN_COLS)} <= CAST('{_EPS2}' AS DOUBLE))"""


@register("dbscan_neighbours", oracle=f"""
WITH z AS ({_profile_sql(MEAN_COLS)}), {_PAIRS}
SELECT a AS station, count(*) AS n_neighbours, count(*) >= 2 AS is_core FROM pairs GROUP BY 1
""")
def q_dbscan_neighbours(spark, sf_dir):
    """Neighbours within eps 0.8 (self included) on the scaled mean profile; core = 2+."""
    z = scaled_profile(spark, sf_dir, MEAN_COLS)
    return clusters.dbscan_neighbours(z, MEAN_COLS, "station", 0.8, 2)


@register("cluster_dbscan", oracle=f"""
WITH RECURSIVE z AS ({_profile_sql(MEAN_COLS)}), {_PAIRS},
core AS (SELECT a FROM pairs GROUP BY a HAVING count(*) >= 2),
ce AS (SELECT a, b FROM pairs WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
reach(src, dst) AS (SELECT a, b FROM ce UNION SELECT r.src, ce.b FROM reach r JOIN ce ON r.dst = ce.a),
lab AS (SELECT src AS node, min(dst) AS label FROM reach GROUP BY 1),
border AS (SELECT p.a AS node, min(l.label) AS bl FROM pairs p JOIN lab l ON p.b = l.node GROUP BY 1)
SELECT z.station, CAST(coalesce(l.label, b.bl, -1) AS BIGINT) AS cluster_dbscan
FROM z LEFT JOIN lab l ON z.station = l.node LEFT JOIN border b ON z.station = b.node
""")
def q_cluster_dbscan(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    z = scaled_profile(spark, sf_dir, MEAN_COLS)
    return clusters.dbscan(z, MEAN_COLS, "station", 0.8, 2)


def _kmeans(spark, sf_dir):
    z = scaled_profile(spark, sf_dir)
    model, k, sil, _ = clusters.kmeans_select(z, PROFILE_COLS)
    return z, model


@register("cluster_kmeans")
def q_cluster_kmeans(spark, sf_dir):
    """k in 3..5, best of several seeds per k by cost, best k by silhouette."""
    z, model = _kmeans(spark, sf_dir)
    return clusters.kmeans_labels(model, z, PROFILE_COLS, "station")


@register("kmeans_fixpoint", oracle="""
SELECT count(DISTINCT l_suppkey) AS points, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS centres_off FROM lineitem
""")
def q_kmeans_fixpoint(spark, sf_dir):
    """What makes the chosen model one: no point is nearer to another centre than to its own, and
    no centre is further from the mean of its points than a settled fit may be."""
    z, model = _kmeans(spark, sf_dir)
    labelled = z.join(clusters.kmeans_labels(model, z, PROFILE_COLS, "station"), "station")
    means = {r["cluster_kmeans"]: r for r in labelled.groupBy("cluster_kmeans").agg(*[F.avg(c).alias(c) for c in PROFILE_COLS]).collect()}
    off = sum(sum((means[i][c] - v) ** 2 for c, v in zip(PROFILE_COLS, m)) > clusters.KMEANS_TOL if i in means else 1
              for i, m in enumerate(model.clusterCenters()))
    gaps = F.array(*[sum(((F.col(c) - float(v)) ** 2 for c, v in zip(PROFILE_COLS, m)), F.lit(0.0)) for m in model.clusterCenters()])
    away = F.array_min(gaps) < F.get(gaps, F.col("cluster_kmeans")) - 1e-9
    return labelled.agg(F.count(F.lit(1)).alias("points"), F.count(F.when(away, 1)).alias("misplaced"),
                        F.lit(off).cast("long").alias("centres_off"))


@register("station_clusters")
def q_station_clusters(spark, sf_dir):
    """Profile with both label sets attached (k-means on all columns, density on means); the
    profile is aggregated once."""
    ensure_checkpoint_dir(spark)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), *_MEASURES)
    prof = stored(station_profile(li, "station", _MEASURES), "profile")
    z = sized_cache(scale_standard(prof.select("station", *PROFILE_COLS), PROFILE_COLS))
    model = clusters.kmeans_select(z, PROFILE_COLS)[0]
    km = clusters.kmeans_labels(model, z, PROFILE_COLS, "station")
    db = clusters.dbscan(z.select("station", *MEAN_COLS), MEAN_COLS, "station", 0.8, 2)
    return prof.join(km, "station").join(db, "station")


@register("cluster_assign")
def q_cluster_assign(spark, sf_dir):
    """Assign profile rows to the fitted k-means model; text by the cluster's rank of mean
    quantity (cleanest first)."""
    z, model = _kmeans(spark, sf_dir)
    labels = clusters.kmeans_labels(model, z, PROFILE_COLS, "station")
    desc = clusters.describe_clusters(labels, z, "station", "cluster_kmeans", "l_quantity_mean")
    return labels.join(F.broadcast(desc), "cluster_kmeans")  # k rows


# --- projection ------------------------------------------------------------------------

@register("pca_covariance", oracle=" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {R6(f'covar_samp({a}, {b})')} AS covariance FROM lineitem"
    for i, a in enumerate(_MEASURES) for b in _MEASURES[i:]))
def q_pca_covariance(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*_MEASURES)
    return round_doubles(projection.covariance(li, _MEASURES))


def _projection(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_returnflag").alias("aqi_category"), *_MEASURES)
    proj, _, _ = projection.pca_projection(li, _MEASURES, keep=["station", "aqi_category"])
    return proj


@register("pca_project")
def q_pca_project(spark, sf_dir):
    """Standardise, principal components with fixed signs, two-dimensional projection."""
    return _projection(spark, sf_dir)


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    """Explained variance ratio of every component of the standardised measures and the
    number of components reaching 95%."""
    li = table(spark, sf_dir, "lineitem").select(*_MEASURES).na.drop(how="any")
    comps, ratio, n_comp = projection.fit_pca(scale_standard(li, _MEASURES), _MEASURES)
    return projection.variance_table(spark, ratio, n_comp)


@register("projection_points")
def q_projection_points(spark, sf_dir):
    """Projection table written to the shared checkpoint folder and read back; numeric
    NULLs -> 0, text NULLs -> 'Unknown' (a missing folder gives an empty table)."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"projections-{uuid.uuid4().hex}")
    _projection(spark, sf_dir).write.mode("overwrite").parquet(path)
    from aerolytics.sources.files import read_projection_points
    return read_projection_points(spark, path)
