"""Registered queries: CSV families read by column name (A1-A3, A5), NULL keys, string keys.

The CSV queries write files derived from the given tables below the shared checkpoint
folder, in two column orders and with further columns, and read them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aerolytics.operators import clusters, sampling
from aerolytics.plans.ml_queries import MEAN_COLS, scaled_profile
from aerolytics.plans.registry import ORACLES, register
from aerolytics.session import ensure_checkpoint_dir
from aerolytics.sources import files
from aerolytics.sources.tables import readings, table


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("scan_readings", oracle="""
SELECT CAST(event_id AS INTEGER) AS "No", CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS pm25, CAST(user_id AS DOUBLE) AS pm10,
       CASE WHEN event_id % 2 = 1 THEN CAST(0.5 AS DOUBLE) END AS temp, event_type AS station
FROM events
""")
def q_scan_readings(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("ts")
    cols = {"No": F.col("event_id"), "year": F.year(t), "month": F.month(t), "day": F.day(t), "hour": F.hour(t),
            "PM2.5": F.when(F.col("event_id") % 7 != 0, F.col("value")), "PM10": F.col("user_id"),
            "TEMP": F.lit(0.5), "station": F.col("event_type"), "remark": F.lit("x")}
    paths = []
    for odd, names in ((0, [c for c in reversed(cols) if c != "TEMP"]), (1, list(cols))):
        paths.append(_folder(spark, "readings-csv"))
        (e.where(F.col("event_id") % 2 == odd).select(*[cols[c].alias(c) for c in names])
         .write.option("header", True).option("nullValue", "NA").csv(paths[-1]))
    raw = files.to_internal(files.read_by_name(spark, paths, files.READINGS_SCHEMA, nullValue="NA"))
    return raw.select("No", "year", "month", "day", "hour", "pm25", "pm10", "temp", "station")


@register("scan_country_aqi", oracle="""
SELECT CAST(c_nationkey AS VARCHAR) AS country, c_name AS city, CAST(c_custkey AS VARCHAR) AS aqi_value,
       c_mktsegment AS aqi_category, CAST(c_custkey * 0.5 AS DOUBLE) AS lat, CAST(c_nationkey * 0.25 AS DOUBLE) AS lng
FROM customer
""")
def q_scan_country_aqi(spark, sf_dir):
    path = _folder(spark, "aqi-csv")
    (table(spark, sf_dir, "customer").select(
        (F.col("c_nationkey") * F.lit(0.25)).alias("lng"), F.lit("7").alias("CO AQI Value"),
        F.col("c_name").alias("City"), (F.col("c_custkey") * F.lit(0.5)).alias("lat"),
        F.col("c_mktsegment").alias("AQI Category"), F.col("c_custkey").alias("AQI Value"),
        F.col("c_nationkey").alias("Country")).write.option("header", True).csv(path))
    d = files.read_global_aqi(spark, path)
    return d.select(F.col("Country").alias("country"), F.col("City").alias("city"), F.col("AQI Value").alias("aqi_value"),
                    F.col("AQI Category").alias("aqi_category"), "lat", "lng")


@register("scan_sensor", oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS "Date", c_acctbal AS co FROM customer
""")
def q_scan_sensor(spark, sf_dir):
    path = _folder(spark, "sensor-csv")
    (table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Date"),
        F.translate(F.col("c_acctbal").cast("string"), ".", ",").alias("CO(GT)"))
        .write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path))
    return files.read_sensor(spark, path).select("Date", F.col("`CO(GT)`").alias("co"))


@register("scan_batch", oracle="""
SELECT c_custkey AS id, c_acctbal AS pm10, CAST(c_nationkey AS DOUBLE) AS temp FROM customer
""")
def q_scan_batch(spark, sf_dir):
    path = _folder(spark, "batch-csv")
    (table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("TEMP"),
                                             F.col("c_acctbal").alias("PM10")).write.option("header", True).csv(path))
    d = files.read_batch_csv(spark, path, ["pm10", "temp"])
    return d.select(F.col("id").cast("long").alias("id"), "pm10", "temp")


_NULL_STATION = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END"


@register("split_time_nulls", oracle=f"""
SELECT event_id, station, datetime > lo + to_microseconds((date_diff('microsecond', lo, hi) * 4) // 5) AS is_test
FROM (SELECT event_id, {_NULL_STATION} AS station, ts AS datetime,
             min(ts) OVER (PARTITION BY {_NULL_STATION}) AS lo, max(ts) OVER (PARTITION BY {_NULL_STATION}) AS hi
      FROM events) t
""")
def q_split_time_nulls(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("station", F.when(F.col("event_id") % 9 != 0, F.col("station")))
    return sampling.split_time(r, "station", "datetime", 0.2).select("event_id", "station", "is_test")


# the clusters of `cluster_dbscan` numbered by their smallest key as text
@register("cluster_dbscan_named", oracle=f"""
WITH base AS ({ORACLES['cluster_dbscan']}),
named AS (SELECT 's' || lpad(CAST(station AS VARCHAR), 9, '0') AS station, cluster_dbscan AS c FROM base),
low AS (SELECT c, dense_rank() OVER (ORDER BY min(c)) - 1 AS k FROM named WHERE c >= 0 GROUP BY c)
SELECT station, CAST(coalesce(k, -1) AS BIGINT) AS cluster_dbscan FROM named LEFT JOIN low USING (c)
""")
def q_cluster_dbscan_named(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    z = scaled_profile(spark, sf_dir, MEAN_COLS).withColumn(
        "station", F.concat(F.lit("s"), F.lpad(F.col("station").cast("string"), 9, "0")))
    return clusters.dbscan(z, MEAN_COLS, "station", 0.8, 2)
