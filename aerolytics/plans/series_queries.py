"""Registered queries: resampling, interpolation, sampling, splits, joins, maps, scan union
(C3, C4, C14, D5, D9, E3-E7, B16, B20-B21, A1, G1-G3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolytics.functions.aqi import aqi_category
from aerolytics.functions.scalar import clip
from aerolytics.operators import joins, maps, resample, sampling
from aerolytics.plans.feature_queries import sql_category, sql_code
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.sources.tables import readings, table, with_empty_weeks, with_hourly_gaps

_GAPS = "SELECT event_type AS station, ts AS datetime, value AS pm25 FROM events WHERE hour(ts) % 5 <> 0"
_HOURLY = f"""
WITH h AS (SELECT station, date_trunc('hour', datetime) AS datetime, avg(pm25) AS pm25
           FROM ({_GAPS}) r WHERE pm25 IS NOT NULL GROUP BY 1, 2),
b AS (SELECT station, min(datetime) AS lo, max(datetime) AS hi FROM h GROUP BY 1),
g AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM b)
SELECT g.station, g.datetime, h.pm25 FROM g LEFT JOIN h USING (station, datetime)
"""


def _gappy(spark, sf_dir):
    return with_hourly_gaps(readings(spark, sf_dir).drop("event_id"))


@register("resample_hourly", oracle=f"SELECT station, datetime, {R6('pm25')} AS pm25 FROM ({_HOURLY}) x")
def q_resample_hourly(spark, sf_dir):
    return round_doubles(resample.resample_hourly(_gappy(spark, sf_dir)))


def interp_sql(hourly_sql: str) -> str:
    """Linear interpolation over an hourly (station, datetime, pm25) relation."""
    return f"""
SELECT station, datetime, CASE WHEN pm25 IS NOT NULL THEN pm25 WHEN pv IS NULL THEN NULL
  WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * CAST(date_diff('second', pt, datetime) AS DOUBLE) / CAST(date_diff('second', pt, nt) AS DOUBLE) END AS pm25
FROM (SELECT *,
  last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN pm25 IS NOT NULL THEN datetime END IGNORE NULLS) OVER (PARTITION BY station ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
  first_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN pm25 IS NOT NULL THEN datetime END IGNORE NULLS) OVER (PARTITION BY station ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
  FROM ({hourly_sql}) x) y
"""


def hourly_sql(src: str) -> str:
    """Hourly mean on a complete calendar over a (station, datetime, pm25) relation."""
    return f"""
WITH h AS (SELECT station, date_trunc('hour', datetime) AS datetime, avg(pm25) AS pm25
           FROM ({src}) r WHERE pm25 IS NOT NULL GROUP BY 1, 2),
b AS (SELECT station, min(datetime) AS lo, max(datetime) AS hi FROM h GROUP BY 1),
g AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM b)
SELECT g.station, g.datetime, h.pm25 FROM g LEFT JOIN h USING (station, datetime)
"""


@register("interpolate_linear", oracle=f"SELECT station, datetime, {R6('pm25')} AS pm25 FROM ({interp_sql(_HOURLY)}) z")
def q_interpolate_linear(spark, sf_dir):
    return round_doubles(resample.prepare_series(_gappy(spark, sf_dir)))


def _weekly_sql(src: str) -> str:
    return f"""
WITH w AS (SELECT station, CAST(date_trunc('week', datetime) AS DATE) + 6 AS wk,
                  avg(CASE WHEN pm25 < 0 THEN 0 ELSE pm25 END) AS m FROM ({src}) r GROUP BY 1, 2),
b AS (SELECT station, min(wk) AS lo, max(wk) AS hi FROM w GROUP BY 1),
g AS (SELECT station, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS wk FROM b)
SELECT g.station, strftime(g.wk, '%Y-%m-%d') AS week_end, {R6('round(coalesce(w.m, 0), 2)')} AS mean
FROM g LEFT JOIN w USING (station, wk)
"""


@register("resample_weekly", oracle=_weekly_sql(
    "SELECT event_type AS station, ts AS datetime, value - 20 AS pm25 FROM events "
    "WHERE ts < TIMESTAMP '2024-01-08' OR ts >= TIMESTAMP '2024-01-22'"))
def q_resample_weekly(spark, sf_dir):
    """Negatives (value - 20) clipped before the mean; two empty weeks filled with 0."""
    r = with_empty_weeks(readings(spark, sf_dir)).withColumn("pm25", F.col("pm25") - 20)
    return round_doubles(resample.resample_weekly(r))


@register("resample_weekly_orders", oracle=_weekly_sql(
    "SELECT o_orderpriority AS station, o_orderdate AS datetime, o_totalprice / 1000 AS pm25 FROM orders"))
def q_resample_weekly_orders(spark, sf_dir):
    """Long daily series (1995-2001) per order priority, weekly."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("station"), F.col("o_orderdate").alias("datetime"),
        (F.col("o_totalprice") / 1000).alias("pm25"))
    return round_doubles(resample.resample_weekly(o))


# --- sampling and splits ------------------------------------------------------------

_MD5 = "md5(CAST(event_id AS VARCHAR))"


@register("sample_per_group", oracle=f"""
SELECT event_id, station FROM (
  SELECT event_id, event_type AS station,
    row_number() OVER (PARTITION BY event_type ORDER BY {_MD5}, event_id) AS rk FROM events) t
WHERE rk <= 83
""")
def q_sample_per_group(spark, sf_dir):
    r = readings(spark, sf_dir).select("event_id", "station")
    return sampling.sample_per_group(r, "station", "event_id", 83)


@register("sample_n", oracle=f"""
SELECT event_id, event_type AS station FROM events ORDER BY {_MD5}, event_id LIMIT 1000
""")
def q_sample_n(spark, sf_dir):
    r = readings(spark, sf_dir).select("event_id", "station")
    return sampling.sample_n(r, "event_id", 1000)


@register("split_hash", oracle=f"""
SELECT event_id, CAST('0x' || substr({_MD5}, 1, 8) AS BIGINT) % 10 < 2 AS is_test FROM events
""")
def q_split_hash(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return sampling.split_hash(ev, "event_id")


@register("split_stratified", oracle=f"""
SELECT event_id, aqi_label,
  percent_rank() OVER (PARTITION BY aqi_label ORDER BY {_MD5}, event_id) < 0.2 AS is_test
FROM (SELECT event_id, {sql_code('value')} AS aqi_label FROM events) t
""")
def q_split_stratified(spark, sf_dir):
    from aerolytics.functions.aqi import aqi_code
    ev = table(spark, sf_dir, "events").select("event_id", aqi_code("value").alias("aqi_label"))
    return sampling.split_stratified(ev, "aqi_label", "event_id", 0.2)


@register("split_time", oracle="""
SELECT event_id, station, datetime > lo + to_microseconds((date_diff('microsecond', lo, hi) * 4) // 5) AS is_test
FROM (SELECT event_id, event_type AS station, ts AS datetime,
             min(ts) OVER (PARTITION BY event_type) AS lo, max(ts) OVER (PARTITION BY event_type) AS hi
      FROM events) t
""")
def q_split_time(spark, sf_dir):
    r = readings(spark, sf_dir).select("event_id", "station", "datetime")
    return sampling.split_time(r, "station", "datetime", 0.2).select("event_id", "station", "is_test")


@register("holdout_tail", oracle="""
SELECT event_id, station, rk <= 24 AS is_test FROM (
  SELECT event_id, user_id AS station, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rk,
         count(*) OVER (PARTITION BY user_id) AS n FROM events) t
WHERE n >= 48
""")
def q_holdout_tail(spark, sf_dir):
    r = readings(spark, sf_dir, "user_id").select("event_id", "station", "datetime")
    flagged, _ = sampling.holdout_tail(r, "station", "datetime", horizon=24)
    return flagged.select("event_id", "station", "is_test")


# --- membership joins, scan union, maps -------------------------------------------

def _supplier_counts(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _station_list(spark, sf_dir):
    """Allow-list: the suppliers of the AMERICA and ASIA regions (a dimension join)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    r = (table(spark, sf_dir, "region").filter(F.col("r_name").isin("AMERICA", "ASIA"))
         .select(F.col("r_regionkey").alias("n_regionkey")))
    listed = s.join(joins.bounded_broadcast(n), "s_nationkey").join(joins.bounded_broadcast(r), "n_regionkey")
    return listed.select(F.col("s_suppkey").alias("l_suppkey"))


_LISTED = ("SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey "
           "JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'ASIA')")


@register("allowed_stations", oracle=f"""
SELECT l_suppkey, count(*) AS n_rows FROM lineitem
WHERE l_suppkey IN ({_LISTED}) GROUP BY 1
""")
def q_allowed_stations(spark, sf_dir):
    return joins.allowed(_supplier_counts(spark, sf_dir), _station_list(spark, sf_dir), "l_suppkey")


@register("rejected_stations", oracle=f"""
SELECT l_suppkey, count(*) AS n_rows FROM lineitem
WHERE l_suppkey NOT IN ({_LISTED}) GROUP BY 1
""")
def q_rejected_stations(spark, sf_dir):
    return joins.rejected(_supplier_counts(spark, sf_dir), _station_list(spark, sf_dir), "l_suppkey")


@register("scan_union", oracle=f"""
SELECT l_suppkey, count(*) AS n_rows, {R6('sum(l_quantity)')} AS sum_qty FROM lineitem GROUP BY 1
""")
def q_scan_union(spark, sf_dir):
    """Two halves of one table with columns in a different order, unioned by name."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_linenumber")
    a = li.filter(F.col("l_linenumber") % 2 == 0).select("l_suppkey", "l_quantity")
    b = li.filter(F.col("l_linenumber") % 2 != 0).select("l_quantity", "l_suppkey")
    u = a.unionByName(b)
    return round_doubles(u.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"),
                                                    F.sum("l_quantity").alias("sum_qty")))


def _aqi_points(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = joins.lookup_join(c, n.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
    aqi = clip(F.col("c_acctbal") / 20, 0.0, 500.0)
    return j.select(F.col("c_name").alias("City"), F.col("n_name").alias("Country"),
                    F.col("n_regionkey").cast("double").alias("lat"),
                    (F.col("c_nationkey") - 12).cast("double").alias("lng"),
                    aqi.alias("AQI Value"), aqi_category(aqi).alias("AQI Category"))


_POINTS_SQL = f"""
SELECT c_name AS city, n_name AS country, CAST(n_regionkey AS DOUBLE) AS lat,
  CAST(c_nationkey - 12 AS DOUBLE) AS lng, a AS aqi_value, {sql_category('a')} AS aqi_category
FROM (SELECT *, CASE WHEN c_acctbal / 20 < 0 THEN 0 WHEN c_acctbal / 20 > 500 THEN 500 ELSE c_acctbal / 20 END AS a
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) t
"""


@register("map_points", oracle=f"""
SELECT city, country, lat, lng, {R6('aqi_value')} AS aqi_value, aqi_category,
  {R6('least(greatest(aqi_value / 10, 4), 15)')} AS radius
FROM ({_POINTS_SQL}) p WHERE lat <> 0 AND lng <> 0
""")
def q_map_points(spark, sf_dir):
    return round_doubles(maps.map_points(_aqi_points(spark, sf_dir)))


@register("map_summary", oracle=f"""
SELECT count(*) AS total_points, count(*) FILTER (WHERE lat <> 0 AND lng <> 0) AS mappable_points,
  count(*) FILTER (WHERE lat <> 0 AND lng <> 0 AND aqi_category = 'Hazardous') AS hazardous_points
FROM ({_POINTS_SQL}) p
""")
def q_map_summary(spark, sf_dir):
    pts = maps.map_points(_aqi_points(spark, sf_dir), mappable_only=False)
    return maps.map_summary(pts)
