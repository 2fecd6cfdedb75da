"""Registered streaming queries over the events table as a file stream: watermarked hourly
mean (J2), lags with state (J3), scoring into a replay-safe table (J1)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from aerolytics.constants import PM25_LAGS, ROLLING_WINDOWS
from aerolytics.functions.calendar import trunc_ntz
from aerolytics.operators import models
from aerolytics.plans.feature_queries import (READINGS_USER, features_by_user, sql_category, sql_lags,
                                              sql_rolling)
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.sources.tables import readings
from aerolytics.streaming.lags import lag_state_stream
from aerolytics.streaming.operators import (arrive_in_batches, epoch_sink, hourly_mean_stream, read_stream,
                                            run_scoring, run_to_table, scratch)


@register("stream_hourly_mean", oracle=f"""
WITH h AS (SELECT event_type AS station, date_trunc('hour', ts) AS datetime, avg(value) AS pm25
           FROM events GROUP BY 1, 2)
SELECT station, datetime, {R6('pm25')} AS pm25 FROM h
WHERE datetime + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def q_stream_hourly_mean(spark, sf_dir):
    """``events`` as a Parquet file stream, one-hour watermark, append mode, run to the
    end with ``availableNow`` and read back from the Parquet sink."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = read_stream(spark, sf_dir, schema, glob="events.parquet").select(
        F.col("event_type").alias("station"), F.col("ts").alias("datetime"),
        F.col("value").alias("pm25"))
    out = run_to_table(spark, hourly_mean_stream(stream, delay="1 hour"), "stream-hourly")
    return round_doubles(out)


_SEGMENT = "PARTITION BY station ORDER BY datetime, event_id"


@register("stream_lags", oracle=f"""
WITH r AS (SELECT event_id, user_id AS station, date_trunc('hour', ts) AS datetime, value AS pm25 FROM events),
g AS (SELECT *, CASE WHEN datetime - lag(datetime) OVER ({_SEGMENT}) > INTERVAL 18 HOUR THEN 1 ELSE 0 END AS cut FROM r),
s AS (SELECT *, sum(cut) OVER ({_SEGMENT} ROWS UNBOUNDED PRECEDING) AS seg FROM g)
SELECT event_id, station, datetime, {R6('pm25')} AS pm25, {sql_lags('pm25', PM25_LAGS, 'station, seg', 'datetime, event_id')},
  {sql_rolling('pm25', ROLLING_WINDOWS, 'station, seg', 'datetime, event_id')}, CAST(0 AS BIGINT) AS late_dropped
FROM s
""")
def q_stream_lags(spark, sf_dir):
    """Readings per user with hourly times (many ties) arriving in three micro-batches; a user
    silent for more than 18 hours starts anew. Equal to windows over the whole table."""
    r = readings(spark, sf_dir, "user_id")
    base = scratch(spark, "stream-lags")
    schema = r.schema

    def run():
        stream = read_stream(spark, f"{base}/in", schema)
        timed = stream.withColumn("datetime", trunc_ntz("hour", "datetime"))
        out = lag_state_stream(timed, expire="18 hours", delay="1 hour")
        q = (out.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
        q.awaitTermination()

    arrive_in_batches(r, f"{base}/in", "datetime", 3, run)
    return round_doubles(spark.read.parquet(f"{base}/out"))


_RIDGE = ["pm25_lag1", "hour_sin"]


def ridge_sql(rows: str) -> str:
    """CTEs up to p(id, p): ridge with penalty 1 of y on two standardised columns (x1, x2) of
    ``rows``, solved by Cramer's rule."""
    return f"""
t AS ({rows}),
m AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, stddev_samp(x1) AS s1, stddev_samp(x2) AS s2 FROM t),
z AS (SELECT event_id, y - my AS y, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, my FROM t, m),
g AS (SELECT sum(z1 * z1) + 1 AS a, sum(z1 * z2) AS b, sum(z2 * z2) + 1 AS c, sum(z1 * y) AS u, sum(z2 * y) AS v FROM z),
p AS (SELECT event_id, my + (u * c - b * v) / (a * c - b * b) * z1 + (a * v - b * u) / (a * c - b * b) * z2 AS p FROM z, g)"""


_LAGGED = f"""SELECT * FROM (
  SELECT event_id, pm25 AS y, lag(pm25, 1) OVER w AS x1, sin(2 * pi() * hour(datetime) / 24) AS x2, lag(pm25, 24) OVER w AS x24
  FROM ({READINGS_USER}) r WINDOW w AS (PARTITION BY station ORDER BY datetime)) f WHERE x1 IS NOT NULL AND x24 IS NOT NULL"""


def stored_ridge(spark, feats, base: str):
    """Ridge on two features, fitted on the feature table and saved; returns the model's path."""
    inp, names = models.model_input(feats, _RIDGE, "pm25")
    inp = inp.cache()
    est = models.regressors("pm25", models.ridge_reg_param(inp, "pm25"))[2][1]
    path = os.path.join(base, "model")
    models.save_model(models.make_pipeline(names, est).fit(inp), path)
    inp.unpersist()
    return path


@register("stream_score", oracle=f"""
WITH {ridge_sql(_LAGGED)}
SELECT event_id, round(greatest(p, 0), 2) AS pm25_prediction, {sql_category('p')} AS aqi_category FROM p
""")
def q_stream_score(spark, sf_dir):
    """The feature table arrives in three files sets and is scored by a stored ridge model; the
    last micro-batch is then run a second time, as after a failure before its commit."""
    base = scratch(spark, "stream-score")
    feats = features_by_user(spark, sf_dir).select("event_id", "datetime", "pm25", *_RIDGE).cache()
    model = stored_ridge(spark, feats, base)
    sink = epoch_sink(model, _RIDGE, f"{base}/out", keep=["event_id"])
    last = {}

    def watched(batch, epoch):
        sink(batch, epoch)
        last["epoch"], last["ids"] = epoch, spark.read.parquet(f"{base}/out/epoch={epoch}").select("event_id")

    def run():
        run_scoring(read_stream(spark, f"{base}/in", feats.schema), watched, f"{base}/state")

    arrive_in_batches(feats, f"{base}/in", "datetime", 3, run)
    if last:
        again = spark.read.schema(feats.schema).parquet(f"{base}/in").join(last["ids"], "event_id", "left_semi")
        sink(again.checkpoint(), last["epoch"])
    feats.unpersist()
    return spark.read.parquet(f"{base}/out").drop("epoch")
