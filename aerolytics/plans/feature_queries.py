"""Registered queries: features, labels, profiles, recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolytics.constants import AQI_CATEGORIES, PM25_BREAKPOINTS, PM25_LAGS, ROLLING_WINDOWS
from aerolytics.functions.aqi import category_to_code
from aerolytics.operators import features as feat
from aerolytics.operators import profiles
from aerolytics.operators.keyed import keyed_frame
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.sources.tables import readings, table

# --- SQL building blocks for the oracle -------------------------------------------


def sql_calendar(t: str) -> str:
    parts = [f"CAST(hour({t}) AS INTEGER) AS hour", f"CAST(month({t}) AS INTEGER) AS month",
             f"CAST(isodow({t}) - 1 AS INTEGER) AS dayofweek",
             f"CAST(dayofyear({t}) AS INTEGER) AS dayofyear"]
    for name, expr, p in (("hour", f"hour({t})", 24), ("month", f"month({t})", 12),
                          ("dow", f"(isodow({t}) - 1)", 7)):
        parts.append(f"{R6(f'sin(2 * pi() * {expr} / {p})')} AS {name}_sin")
        parts.append(f"{R6(f'cos(2 * pi() * {expr} / {p})')} AS {name}_cos")
    return ",\n  ".join(parts)


def sql_over(key: str | None, order: str, frame: str = "") -> str:
    part = f"PARTITION BY {key} " if key else ""
    return f"OVER ({part}ORDER BY {order} {frame})"


def sql_lags(target: str, lags, key, order) -> str:
    return ",\n  ".join(f"{R6(f'lag({target}, {k}) {sql_over(key, order)}')} AS {target}_lag{k}"
                        for k in lags)


def sql_rolling(target: str, windows, key, order) -> str:
    out = []
    for n in windows:
        fr = f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
        out.append(f"{R6(f'avg({target}) {sql_over(key, order, fr)}')} AS {target}_roll_mean{n}")
        out.append(f"{R6(f'coalesce(stddev_samp({target}) {sql_over(key, order, fr)}, 0)')} "
                   f"AS {target}_roll_std{n}")
    return ",\n  ".join(out)


def sql_category(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {b} THEN '{n}'" for n, b in zip(AQI_CATEGORIES, PM25_BREAKPOINTS))
    return f"CASE {whens} ELSE '{AQI_CATEGORIES[-1]}' END"


def sql_code(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {b} THEN {i}" for i, b in enumerate(PM25_BREAKPOINTS))
    return f"CAST(CASE {whens} ELSE {len(PM25_BREAKPOINTS)} END AS INTEGER)"


READINGS_USER = "SELECT event_id, user_id AS station, ts AS datetime, value AS pm25 FROM events"
READINGS_TYPE = "SELECT event_id, event_type AS station, ts AS datetime, value AS pm25 FROM events"

# --- D8 flagship --------------------------------------------------------------------


def features_by_user(spark, sf_dir):
    r = readings(spark, sf_dir, "user_id")
    return feat.build_features(r, key="station", time="datetime", target="pm25")


@register("build_features", oracle=f"""
SELECT * FROM (
SELECT event_id, station, datetime, {R6('pm25')} AS pm25,
  {sql_calendar('datetime')},
  {sql_lags('pm25', PM25_LAGS, 'station', 'datetime')},
  {sql_rolling('pm25', ROLLING_WINDOWS, 'station', 'datetime')},
  {sql_category('pm25')} AS aqi_category,
  {sql_code('pm25')} AS aqi_label
FROM ({READINGS_USER}) r) f
WHERE pm25_lag1 IS NOT NULL AND pm25_lag24 IS NOT NULL
""")
def q_build_features(spark, sf_dir):
    return round_doubles(features_by_user(spark, sf_dir))


@register("calendar_features", oracle=f"""
SELECT event_id, {sql_calendar('ts')} FROM events
""")
def q_calendar_features(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return round_doubles(feat.add_calendar_features(ev, "ts").drop("ts"))


@register("lag_features", oracle=f"""
SELECT event_id, station, {sql_lags('pm25', PM25_LAGS, 'station', 'datetime')}
FROM ({READINGS_USER}) r
""")
def q_lag_features(spark, sf_dir):
    r = readings(spark, sf_dir, "user_id")
    out = feat.add_lag_features(r, "pm25", PM25_LAGS, key="station", time="datetime")
    return round_doubles(out.drop("datetime", "pm25"))


@register("rolling_features", oracle=f"""
SELECT event_id, station, {sql_rolling('pm25', ROLLING_WINDOWS, 'station', 'datetime')}
FROM ({READINGS_USER}) r
""")
def q_rolling_features(spark, sf_dir):
    r = readings(spark, sf_dir, "user_id")
    out = feat.add_rolling_features(r, "pm25", ROLLING_WINDOWS, key="station", time="datetime")
    return round_doubles(out.drop("datetime", "pm25"))


@register("lag_global", oracle=f"""
SELECT event_id, {R6('lag(value, 1) OVER (ORDER BY ts)')} AS lag1,
  {R6('avg(value) OVER (ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)')} AS roll_mean3
FROM events
""")
def q_lag_global(spark, sf_dir):
    """Ungrouped lag / rolling (D6): one key for the whole table, chunked past one task."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    kf = keyed_frame(ev, [], ["ts"], halo=3)
    out = kf.finish(kf.df.select(
        "event_id", F.lag("value", 1).over(kf.window).alias("lag1"),
        F.avg("value").over(kf.window.rowsBetween(-3, -1)).alias("roll_mean3")))
    return round_doubles(out)


@register("aqi_category", oracle=f"""
SELECT event_id, {R6('value')} AS pm25, {sql_category('value')} AS aqi_category,
  {sql_code('value')} AS aqi_label
FROM events
""")
def q_aqi_category(spark, sf_dir):
    r = readings(spark, sf_dir).select("event_id", "pm25")
    return round_doubles(feat.add_aqi_label(r, "pm25"))


_CAT_SQL = ("CASE event_id % 8 WHEN 0 THEN 'Good' WHEN 1 THEN 'Moderate' "
            "WHEN 2 THEN 'Unhealthy for Sensitive Groups' WHEN 3 THEN 'Unhealthy' "
            "WHEN 4 THEN 'Very Unhealthy' WHEN 5 THEN 'Hazardous' WHEN 6 THEN 'Smoky' END")
_CODE_SQL = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(AQI_CATEGORIES))


@register("category_code", oracle=f"""
SELECT event_id, aqi_category, CAST(coalesce(CASE aqi_category {_CODE_SQL} END, 1) AS INTEGER) AS aqi_label
FROM (SELECT event_id, {_CAT_SQL} AS aqi_category FROM events) t
""")
def q_category_code(spark, sf_dir):
    """Category text -> code with unknown ('Smoky') and NULL texts -> 1."""
    ev = table(spark, sf_dir, "events").select("event_id")
    cat = F.expr(_CAT_SQL)
    return ev.select("event_id", cat.alias("aqi_category")).select(
        "event_id", "aqi_category", category_to_code("aqi_category").alias("aqi_label"))


# --- C1, C2, E2 ---------------------------------------------------------------------

_L_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def supplier_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), *_L_MEASURES)
    return profiles.station_profile(li, "station", _L_MEASURES)


@register("station_profile", oracle="SELECT l_suppkey AS station, " + ", ".join(
    f"{R6(f'avg({m})')} AS {m}_mean, {R6(f'stddev_samp({m})')} AS {m}_std, {R6(f'max({m})')} AS {m}_max"
    for m in _L_MEASURES) + " FROM lineitem GROUP BY l_suppkey")
def q_station_profile(spark, sf_dir):
    return round_doubles(supplier_profile(spark, sf_dir))


_SAFETY_SQL = f"""
SELECT station, CAST(hour(datetime) AS INTEGER) AS hour,
  avg(CASE WHEN {sql_category('pm25')} IN ('Good', 'Moderate') THEN 1 ELSE 0 END) AS safety_score
FROM ({READINGS_TYPE}) r GROUP BY 1, 2
"""


@register("safety_score", oracle=f"SELECT station, hour, {R6('safety_score')} AS safety_score FROM ({_SAFETY_SQL}) s")
def q_safety_score(spark, sf_dir):
    r = readings(spark, sf_dir)
    return round_doubles(profiles.safety_score(r, pm25="pm25"))


@register("recommend_windows", oracle=f"""
SELECT station, rank, hour,
  printf('%02d:00 – %02d:00', hour, hour + 1) AS time_label,
  {R6('round(safety_score, 3)')} AS safety_score,
  CASE WHEN safety_score >= 0.7 THEN '✅ Safe' ELSE '⚠️ Moderate' END AS advice
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY station ORDER BY safety_score DESC, hour) AS INTEGER) AS rank
      FROM ({_SAFETY_SQL}) s) t
WHERE rank <= 5
""")
def q_recommend_windows(spark, sf_dir):
    r = readings(spark, sf_dir)
    prof = profiles.safety_score(r, pm25="pm25")
    return round_doubles(profiles.recommend_windows(prof, top_n=5))
