"""Registered queries on saved artifacts: a CSV scored by a stored pipeline (A5, A8, C7, H18),
row index over split files (F11), padded cluster assignment (H20)."""

from __future__ import annotations

import math
import os

from pyspark.sql import functions as F

from aerolytics.operators import models, stages
from aerolytics.plans.feature_queries import sql_category
from aerolytics.plans.ml_queries import PROFILE_COLS, _MEASURES, _profile_sql, _sq
from aerolytics.plans.registry import register
from aerolytics.plans.source_queries import _folder
from aerolytics.plans.stream_queries import ridge_sql
from aerolytics.operators.profiles import station_profile
from aerolytics.sources import files
from aerolytics.sources.tables import table

_WIND = "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END"
_CODED = f"""SELECT event_id, value AS y, sin(2 * pi() * hour(ts) / 24) AS x1,
  dense_rank() OVER (ORDER BY coalesce({_WIND}, 'N')) - 1 AS x2 FROM events"""


@register("score_csv", oracle=f"""
WITH {ridge_sql(_CODED)}
SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_index, round(greatest(p, 0), 2) AS pm25_prediction,
  {sql_category('p')} AS aqi_category FROM p
""")
def q_score_csv(spark, sf_dir):
    """Readings as CSV files with a time, a wind text (NULL for some) and columns nobody asked
    for; the stored pipeline codes, adds the calendar, pads, scales and predicts."""
    e = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("datetime"), F.expr(_WIND).alias("wd"), F.col("value").alias("pm25"))
    base = _folder(spark, "score-csv")
    features = ["hour_sin", "wd_encoded"]
    raw = stages.CalendarStage(timeCol="datetime")
    coder = stages.TextCoder(inputCol="wd", outputCol="wd_encoded", nullAs="N").fit(e)
    train = stages.PadStage(features=features).transform(coder.transform(raw.transform(e))).select("pm25", *features)
    ridge = models.regressors("pm25", models.ridge_reg_param(train, "pm25"))[2][1]
    fitted = models.make_pipeline(features, ridge).fit(train)
    models.save_model(models.full_pipeline(fitted, features, raw, coder), f"{base}/model")
    (e.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").drop("pm25").withColumn("remark", F.lit("a, b"))
     .write.option("header", True).csv(f"{base}/in"))
    return models.score_csv(spark, f"{base}/in", f"{base}/model")


FILE_ROWS = 1_000_000


@register("scan_batch_rows", oracle="""
SELECT row_number() OVER (ORDER BY l_orderkey, l_quantity, l_tax) - 1 AS row_index, l_orderkey AS id, l_quantity AS pm10, l_tax AS temp
FROM lineitem
""")
def q_scan_batch_rows(spark, sf_dir):
    """The rows of several CSV files, each read in several splits, numbered in file order."""
    path = _folder(spark, "batch-rows")
    order = ["l_orderkey", "l_quantity", "l_tax"]
    lines = table(spark, sf_dir, "lineitem")
    parts = max(3, math.ceil(lines.count() / FILE_ROWS))  # a task sorts one file's rows, whatever the table holds
    (lines.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .select(F.col("l_orderkey").alias("id"), F.col("l_tax").alias("TEMP"), F.col("l_quantity").alias("PM10"))
     .write.option("header", True).csv(path))
    size = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "256k")                         # many splits a file, as of files beyond 128 MB
    try:
        d = files.read_batch_csv(spark, path, ["pm10", "temp"])
    finally:
        spark.conf.set(size, old)
    return d.select("row_index", F.col("id").cast("long").alias("id"), "pm10", "temp")


_GIVEN = [c for c in PROFILE_COLS if not c.startswith("l_tax")]


@register("cluster_assign_padded", oracle=f"""
WITH z AS ({_profile_sql(PROFILE_COLS)}),
c AS (SELECT station % 3 AS cluster, {', '.join(f'avg({c}) AS {c}' for c in PROFILE_COLS)} FROM z GROUP BY 1),
raw AS (SELECT l_suppkey AS station, {', '.join(f"coalesce({a}, 0) AS {m}_{s}" if m != 'l_tax' else f"CAST(0 AS DOUBLE) AS {m}_{s}"
    for m in _MEASURES for s, a in (('mean', f'avg({m})'), ('std', f'stddev_samp({m})'), ('max', f'max({m})')))} FROM lineitem GROUP BY 1),
real AS (SELECT l_suppkey AS station, {', '.join(f"coalesce({a}, 0) AS {m}_{s}"
    for m in _MEASURES for s, a in (('mean', f'avg({m})'), ('std', f'stddev_samp({m})'), ('max', f'max({m})')))} FROM lineitem GROUP BY 1),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in PROFILE_COLS)} FROM real),
a AS (SELECT station, {', '.join(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}' for c in PROFILE_COLS)} FROM raw, st),
d AS (SELECT a.station, b.cluster, {_sq(PROFILE_COLS)} AS d FROM a CROSS JOIN c b)
SELECT station, CAST(arg_min(cluster, (d, cluster)) AS INTEGER) AS cluster FROM d GROUP BY station
""")
def q_cluster_assign_padded(spark, sf_dir):
    """Profiles that lack three columns, assigned by a stored clusterer (scaler, feature list and
    centres in one artifact): the absent columns count as 0 before scaling."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), *_MEASURES)
    prof = station_profile(li, "station", _MEASURES).select("station", *PROFILE_COLS).cache()
    mean, std = stages.standard_stats(prof, PROFILE_COLS)
    scaled = [((F.coalesce(F.col(c), F.lit(0.0)) - m) / (s or 1.0)).alias(c) for c, m, s in zip(PROFILE_COLS, mean, std)]
    centres = prof.select((F.col("station") % 3).alias("k"), *scaled).groupBy("k").agg(
        *[F.avg(c).alias(c) for c in PROFILE_COLS]).orderBy("k").collect()       # three rows
    path = os.path.join(_folder(spark, "clusterer"), "model")
    stages.ProfileAssigner(features=PROFILE_COLS, mean=mean, std=std,
                           centres=[float(r[c]) for r in centres for c in PROFILE_COLS]).write().overwrite().save(path)
    rows = prof.select("station", *_GIVEN)
    out = stages.ProfileAssigner.load(path).transform(rows).select("station", "cluster")
    prof.unpersist()
    return out
