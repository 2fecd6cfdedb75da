"""Registered queries: forecasting stages and forecasts (H14-H17) on the hourly series of
each station (hourly mean on a complete calendar + linear interpolation)."""

from __future__ import annotations

import functools
import math
import os
import uuid

from pyspark.sql import functions as F

from aerolytics.operators import forecast, resample, sampling, serving
from aerolytics.plans.feature_queries import READINGS_TYPE
from aerolytics.operators.storage import sized_cache
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.plans.series_queries import hourly_sql, interp_sql
from aerolytics.session import ensure_checkpoint_dir
from aerolytics.sources.tables import readings

SERIES_SQL = interp_sql(hourly_sql(READINGS_TYPE))


def hourly_series(spark, sf_dir):
    """Hourly series per station (one row per station-hour, bounded by the time span),
    cached: every forecaster reads it in several stages, the raw table is scanned once."""
    return sized_cache(resample.prepare_series(readings(spark, sf_dir).drop("event_id")))


@register("forecast_seasonal", oracle=f"""
WITH s AS ({SERIES_SQL}),
p AS (SELECT station, isodow(datetime) - 1 AS wd, hour(datetime) AS h, avg(pm25) AS m FROM s GROUP BY 1, 2, 3),
l AS (SELECT station, max(datetime) AS last FROM s GROUP BY 1),
f AS (SELECT station, CAST(step AS INTEGER) AS step, last + step * INTERVAL 1 HOUR AS datetime
      FROM l CROSS JOIN (SELECT unnest(generate_series(1, 24)) AS step) g)
SELECT f.station, f.step, f.datetime, {R6('CASE WHEN p.m < 0 THEN 0 ELSE p.m END')} AS yhat
FROM f LEFT JOIN p ON f.station = p.station AND isodow(f.datetime) - 1 = p.wd AND hour(f.datetime) = p.h
""")
def q_forecast_seasonal(spark, sf_dir):
    """Hour-of-week mean baseline, 24 steps past each station's last hour."""
    return round_doubles(forecast.forecast_seasonal(hourly_series(spark, sf_dir)))


_DIFF = f"""SELECT station, d, lag(d, 1) OVER w AS d1, lag(d, 2) OVER w AS d2 FROM (
  SELECT station, datetime, pm25 - lag(pm25, 1) OVER (PARTITION BY station ORDER BY datetime) AS d FROM ({SERIES_SQL}) s) x
  WINDOW w AS (PARTITION BY station ORDER BY datetime)"""
_TERMS = {"m_d": "d", "m_d1": "d1", "m_d2": "d2", "m_dd": "d*d", "m_dd1": "d*d1",
          "m_dd2": "d*d2", "m_d1d1": "d1*d1", "m_d1d2": "d1*d2", "m_d2d2": "d2*d2"}


@register("ar_cross_products", oracle=f"""
SELECT station, count(*) AS n, {', '.join(f"{R6(f'avg({e})')} AS {n}" for n, e in _TERMS.items())}
FROM ({_DIFF}) y WHERE d IS NOT NULL AND d1 IS NOT NULL AND d2 IS NOT NULL GROUP BY 1
""")
def q_ar_cross_products(spark, sf_dir):
    return round_doubles(forecast.ar_cross_products(hourly_series(spark, sf_dir)))


def _fourier_sql() -> str:
    cols = []
    for name, period, order in forecast.FOURIER:
        for k in range(1, order + 1):
            c = repr(2 * math.pi * k / period)
            ang = f"CAST('{c}' AS DOUBLE) * t"
            cols += [f"{R6(f'sin({ang})')} AS {name}_sin{k}", f"{R6(f'cos({ang})')} AS {name}_cos{k}"]
    return ", ".join(cols)


@register("fourier_features", oracle=f"""
SELECT station, datetime, {_fourier_sql()}
FROM (SELECT station, datetime, epoch_us(datetime) / 86400000000.0 AS t FROM ({SERIES_SQL}) s) x
""")
def q_fourier_features(spark, sf_dir):
    """Daily (4), weekly (3) and yearly (10) sin/cos pairs, time in days since the epoch."""
    s = hourly_series(spark, sf_dir).select("station", "datetime")
    return round_doubles(forecast.add_fourier(s))


@register("forecast_arma")
def q_forecast_arma(spark, sf_dir):
    """ARIMA(2,1,2) by two-stage regression, 24 steps per station."""
    return forecast.forecast_arma(hourly_series(spark, sf_dir))


@register("forecast_additive")
def q_forecast_additive(spark, sf_dir):
    """Trend + changepoints + Fourier seasonality, 24 steps with an 80% band."""
    return forecast.forecast_additive(hourly_series(spark, sf_dir))


@register("forecast_holdout")
def q_forecast_holdout(spark, sf_dir):
    """Last 24 hours of every station held out; RMSE / MAE of the three forecasters as
    model_runs rows (task time_series)."""
    series = hourly_series(spark, sf_dir)
    flagged, _ = sampling.holdout_tail(series, "station", "datetime", 24)
    flagged = sized_cache(flagged)  # one split read by three forecasters (hourly-series size)
    train = flagged.filter(~F.col("is_test")).drop("is_test")
    test = flagged.filter(F.col("is_test")).drop("is_test")
    runs = None
    for order, (name, fn) in enumerate((("seasonal", forecast.forecast_seasonal),
                                        ("arima", forecast.forecast_arma),
                                        ("additive", forecast.forecast_additive)), start=1):
        m = forecast.holdout_metrics(test, fn(train)).agg(
            F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))
        r = m.select(F.lit("time_series").alias("task"), F.lit(name).alias("model"),
                     F.lit(order).alias("trained_order"),
                     F.expr("stack(2, 'rmse', rmse, 'mae', mae)").alias("metric", "value"))
        runs = r if runs is None else runs.unionByName(r)
    return runs


#: two forecasters with closed forms in SQL: weekday-hour means, and a straight line
_SERVED = {"seasonal": serving.FORECASTERS["seasonal"],
           "additive": (functools.partial(serving.additive_state, n_changepoints=0, terms=()), serving.serve_additive)}
_Z = repr(1.2815515655446008)


def _fits_sql(rows: str, prefix: str) -> str:
    """Weekday-hour, hour and series means and the least-squares line of ``rows`` per station."""
    return f"""
{prefix}c AS (SELECT station, isodow(datetime) - 1 AS wd, hour(datetime) AS h, avg(pm25) AS m, count(*) AS n FROM {rows} GROUP BY ALL),
{prefix}h AS (SELECT station, hour(datetime) AS h, avg(pm25) AS m, count(*) AS n FROM {rows} GROUP BY ALL),
{prefix}a AS (SELECT station, avg(pm25) AS m, count(*) AS n, min(datetime) AS t0, max(datetime) AS t1 FROM {rows} GROUP BY ALL),
{prefix}r AS (SELECT s.station, s.datetime, s.pm25, c.m AS cm, date_diff('second', t0, s.datetime) / date_diff('second', t0, t1)::DOUBLE AS x
  FROM {rows} s JOIN {prefix}a USING (station) JOIN {prefix}c c ON c.station = s.station AND c.wd = isodow(s.datetime) - 1 AND c.h = hour(s.datetime)),
{prefix}l AS (SELECT station, avg(x) AS mx, avg(pm25) AS my, sum((x - ax) * (x - ax)) AS sxx, sum((x - ax) * (pm25 - ay)) / sum((x - ax) * (x - ax)) AS b,
    count(*) AS n, sum((pm25 - cm) * (pm25 - cm)) AS sse_c FROM (SELECT *, avg(x) OVER w AS ax, avg(pm25) OVER w AS ay FROM {prefix}r
    WINDOW w AS (PARTITION BY station)) q GROUP BY station),
{prefix}v AS (SELECT station, max(l.sse_c) / (max(l.n) - max(g.cells)) AS s2c,
    sum((pm25 - my - b * (x - mx)) * (pm25 - my - b * (x - mx))) / (max(l.n) - 2) AS s2l
  FROM {prefix}r JOIN {prefix}l l USING (station) JOIN (SELECT station, count(*) AS cells FROM {prefix}c GROUP BY station) g USING (station)
  GROUP BY station),
{prefix}f AS (SELECT a.station, step, a.t1 + step * INTERVAL 1 HOUR AS datetime,
    date_diff('second', t0, a.t1 + step * INTERVAL 1 HOUR) / date_diff('second', t0, t1)::DOUBLE AS x
  FROM {prefix}a a, (SELECT unnest(generate_series(1, 24)) AS step) g),
{prefix}p AS (SELECT f.station, step, f.datetime, coalesce(c.m, h.m, a.m) AS ys, v.s2c * (1 + 1.0 / coalesce(c.n, h.n, a.n)) AS vs,
    l.my + l.b * (f.x - l.mx) AS yl, v.s2l * (1 + 1.0 / l.n + (f.x - l.mx) * (f.x - l.mx) / l.sxx) AS vl
  FROM {prefix}f f JOIN {prefix}a a USING (station) JOIN {prefix}l l USING (station) JOIN {prefix}v v USING (station)
  LEFT JOIN {prefix}c c ON c.station = f.station AND c.wd = isodow(f.datetime) - 1 AND c.h = hour(f.datetime)
  LEFT JOIN {prefix}h h ON h.station = f.station AND h.h = hour(f.datetime))"""


@register("forecast_serve", oracle=f"""
WITH s AS ({SERIES_SQL}),
k AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS back FROM s),
tr AS (SELECT station, datetime, pm25 FROM k WHERE back > 24), {_fits_sql('tr', 'held_')}, {_fits_sql('s', 'full_')},
e AS (SELECT station, sqrt(avg((greatest(ys, 0) - pm25) * (greatest(ys, 0) - pm25))) AS es,
        sqrt(avg((greatest(yl, 0) - pm25) * (greatest(yl, 0) - pm25))) AS el FROM held_p JOIN k USING (station, datetime) WHERE back <= 24 GROUP BY station),
o AS (SELECT station, step, full_p.datetime, CASE WHEN es <= el THEN 'seasonal' ELSE 'additive' END AS model,
        CASE WHEN es <= el THEN ys ELSE yl END AS y, {_Z} * sqrt(CASE WHEN es <= el THEN vs ELSE vl END) AS half FROM full_p JOIN e USING (station))
SELECT station, model, CAST(step AS INTEGER) AS step, datetime, round(greatest(y, 0), 2) AS prediction,
  round(greatest(y - half, 0), 2) AS lower, round(greatest(y + half, 0), 2) AS upper FROM o
""")
def q_forecast_serve(spark, sf_dir):
    """Holdout scores choose a forecaster per station, its state is saved, and a request for 24
    hours is answered from the saved states with 80 % bands."""
    series = hourly_series(spark, sf_dir)
    scores, _ = serving.holdout_scores(series, forecasters=_SERVED)
    path = os.path.join(ensure_checkpoint_dir(spark), f"forecasters-{uuid.uuid4().hex}")
    serving.save_states(series, serving.choose(scores), path, forecasters=_SERVED)
    return serving.forecast_request(spark, path, 24, forecasters=_SERVED)
