"""Per-station forecasting for all stations in one job.

Re-aimed, not re-implemented libraries:

* seasonal baseline: mean by (station, weekday, hour) joined onto the future calendar;
* ARIMA(2,1,2) by the two-stage regression of Hannan & Rissanen (1982) on the first
  difference: a long autoregression gives residuals, then the difference is regressed on
  two lags of itself and two lagged residuals;
* additive model (trend with hinge changepoints + daily / weekly / yearly Fourier terms,
  after Taylor & Letham 2018), fitted by penalised least squares.

Every fit is least squares, so the data pass is a Gram-matrix aggregate: each task builds
partial X'X, X'y per station with numpy (``mapInPandas``), Spark sums the p x p entries
per station in a shuffle, and a tiny per-station solve runs in ``applyInPandas`` on one
row. Nothing per series is ever collected: the state per station is O(p^2).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.constants import FORECAST_HORIZON, MAX_FORECAST_HORIZON
from aerolytics.functions.scalar import clip
from aerolytics.operators.joins import null_safe_join

AR_LONG = 10
DAY_S = 86400.0


def check_horizon(h: int) -> int:
    if not 1 <= h <= MAX_FORECAST_HORIZON:
        raise ValueError(f"horizon must be in 1..{MAX_FORECAST_HORIZON}")
    return h


# --- Gram aggregate and per-key solve --------------------------------------------------

def gram_by_key(df: DataFrame, key: str, x_cols, y_col: str,
                max_open_keys: int = 4096) -> DataFrame:
    """Per key: n, X'X (row-major p*p), X'y (p), y'y — rows with NULLs are skipped.

    Partial sums per task (numpy), then one shuffle of p*p+p+2 numbers per key per task.
    """
    x_cols = list(x_cols)
    p = len(x_cols)
    key_type = df.schema[key].dataType.simpleString()

    def emit(acc):
        for k, vec in acc.items():
            yield pd.DataFrame({key: [k] * len(vec), "idx": np.arange(len(vec), dtype=np.int32),
                                "v": vec})

    def partial(batches):
        # per-task partial sums; flushed when many keys are open, so task memory stays
        # bounded by max_open_keys * p^2 whatever the number of keys in the partition
        acc: dict = {}
        for pdf in batches:
            pdf = pdf.dropna(subset=[*x_cols, y_col])
            for k, g in pdf.groupby(key, sort=False, dropna=False):
                k = None if k != k else k                # one NULL key, whatever pandas calls it
                x = g[x_cols].to_numpy(dtype=float)
                y = g[y_col].to_numpy(dtype=float)
                cur = acc.get(k)
                vec = np.concatenate([(x.T @ x).ravel(), x.T @ y, [y @ y, len(y)]])
                acc[k] = vec if cur is None else cur + vec
            if len(acc) >= max_open_keys:
                yield from emit(acc)
                acc = {}
        yield from emit(acc)

    parts = df.select(key, *x_cols, y_col).mapInPandas(
        partial, schema=f"{key} {key_type}, idx int, v double")
    summed = parts.groupBy(key, "idx").agg(F.sum("v").alias("v"))
    packed = summed.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("idx", "v"))).alias("_e"))  # p*p+p+2 entries
    vals = F.transform(F.col("_e"), lambda s: s["v"])
    return packed.select(
        key, F.slice(vals, 1, p * p).alias("xtx"), F.slice(vals, p * p + 1, p).alias("xty"),
        F.element_at(vals, p * p + p + 1).alias("yty"),
        F.element_at(vals, p * p + p + 2).cast("long").alias("n"))


def solve_by_key(gram: DataFrame, key: str, p: int, ridge=None) -> DataFrame:
    """Least squares per key from its Gram row: coef = (X'X + diag(ridge))^-1 X'y, with the
    inverse (row-major) and the residual variance ``s2`` (over n - p rows). Gram rows are
    solved where they are, a batch of small matrices at a time."""
    key_type = gram.schema[key].dataType.simpleString()
    pen = np.diag(np.zeros(p) if ridge is None else np.asarray(ridge, dtype=float))

    def solve(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            xtx = np.stack([np.asarray(r, dtype=float).reshape(p, p) for r in pdf["xtx"]])
            xty = np.stack([np.asarray(r, dtype=float) for r in pdf["xty"]])
            n, yty = pdf["n"].to_numpy(), pdf["yty"].to_numpy(dtype=float)
            inv = np.linalg.pinv(xtx + pen, hermitian=True)
            coef = np.einsum("kij,kj->ki", inv, xty)
            sse = yty - 2 * (coef * xty).sum(axis=1) + np.einsum("ki,kij,kj->k", coef, xtx, coef)
            yield pd.DataFrame({key: pdf[key], "coef": list(coef), "n": n, "inv": list(inv.reshape(len(n), p * p)),
                                "s2": np.maximum(sse, 0.0) / np.maximum(n - p, 1)})

    return gram.mapInPandas(solve, schema=f"{key} {key_type}, coef array<double>, n long, inv array<double>, s2 double")


# --- seasonal baseline (H16) -------------------------------------------------------

def future_hours(series: DataFrame, key: str, time: str, horizon: int) -> DataFrame:
    last = series.groupBy(key).agg(F.max(time).alias("_last"))
    return last.select(key, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "_last") \
        .select(key, "step", F.timestamp_add("HOUR", F.col("step"), F.col("_last")).alias(time))


def forecast_seasonal(series: DataFrame, key: str = "station", time: str = "datetime",
                      value: str = "pm25", horizon: int = FORECAST_HORIZON) -> DataFrame:
    """Mean by (key, weekday, hour) placed on the next ``horizon`` hours; clipped at 0. A
    weekday-hour without a reading takes the mean of its hour, else that of the series."""
    check_horizon(horizon)
    state = seasonal_state(series, key, time, value)
    return (state.select(key, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "last_time", "cells")
            .withColumn(time, F.timestamp_add("HOUR", F.col("step"), F.col("last_time")))
            .select(key, "step", time, clip(_cell(time)["mean"], 0.0).alias("yhat")))


def _cell(time: str) -> Column:
    """The weekday-hour of ``time`` in a state's ``cells``."""
    return F.get("cells", F.weekday(time) * 24 + F.hour(time))


def seasonal_state(series: DataFrame, key: str = "station", time: str = "datetime", value: str = "pm25") -> DataFrame:
    """Per key: ``last_time``, the mean and number of readings of the 168 weekday-hours (those
    without one: of the hour, else of the series) and the residual variance ``s2``. Sums of
    the weekday-hours are aggregated first, so a key's row is made of at most 168."""
    sums = series.groupBy(key, F.weekday(time).alias("_wd"), F.hour(time).alias("_h")).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"), F.max(time).alias("_last"))
    packed = sums.groupBy(key).agg(
        F.max("_last").alias("last_time"), F.collect_list(F.when(F.col("n") > 0, F.struct("_wd", "_h", "n", "m"))).alias("_c"),
        (F.sum(F.col("v") * F.col("n")) / F.greatest(F.sum("n") - F.count(F.when(F.col("n") > 0, F.lit(1))), F.lit(1))).alias("s2"))

    def pooled(rows):
        n = F.aggregate(rows, F.lit(0).cast("long"), lambda a, c: a + c["n"])
        total = F.aggregate(rows, F.lit(0.0), lambda a, c: a + c["m"] * c["n"])
        return F.struct(F.when(n > 0, total / n).alias("mean"), n.alias("n"))

    def cell(i):
        same = F.filter("_c", lambda c: c["_wd"] * 24 + c["_h"] == i)
        hour = F.filter("_c", lambda c: c["_h"] == F.pmod(i, F.lit(24)))
        return F.when(F.size(same) > 0, pooled(same)).when(F.size(hour) > 0, pooled(hour)).otherwise(pooled(F.col("_c")))

    return packed.select(key, "last_time", F.transform(F.sequence(F.lit(0), F.lit(167)), cell).alias("cells"), "s2")


# --- ARIMA(2,1,2) via Hannan-Rissanen ------------------------------------------------

def differenced(series: DataFrame, key: str, time: str, value: str, lags: int) -> DataFrame:
    """``d`` = first difference and its lags ``d1..d{lags}`` per key (one window)."""
    w = Window.partitionBy(key).orderBy(time)
    d = F.col(value) - F.lag(value, 1).over(w)
    base = series.select(key, time, value, d.alias("d"))
    return base.select("*", *[F.lag("d", i).over(w).alias(f"d{i}") for i in range(1, lags + 1)])


def ar_cross_products(series: DataFrame, key: str = "station", time: str = "datetime",
                      value: str = "pm25") -> DataFrame:
    """n and mean products of the differenced series ``d`` with its first two lags: the
    moment matrix of the AR(2) normal equations (means keep magnitudes engine-stable)."""
    d = differenced(series, key, time, value, 2).na.drop(subset=["d", "d1", "d2"])
    terms = {"m_d": "d", "m_d1": "d1", "m_d2": "d2", "m_dd": "d*d", "m_dd1": "d*d1",
             "m_dd2": "d*d2", "m_d1d1": "d1*d1", "m_d1d2": "d1*d2", "m_d2d2": "d2*d2"}
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                              *[F.avg(F.expr(e)).alias(n) for n, e in terms.items()])


def fit_arma(series: DataFrame, key: str = "station", time: str = "datetime",
             value: str = "pm25", long_ar: int = AR_LONG) -> DataFrame:
    """Coefficients [c, phi1, phi2, theta1, theta2] per key (see :func:`_fit_arma_stages`)."""
    return _fit_arma_stages(series, key, time, value, long_ar)[1]


def _fit_arma_stages(series: DataFrame, key: str, time: str, value: str, long_ar: int):
    """Stage 1: AR(long_ar) with intercept -> residuals ``e``; stage 2: ``d`` on
    (1, d1, d2, e1, e2). Returns (differenced rows with residuals, stage-2 coefficients)."""
    xs1 = ["one"] + [f"d{i}" for i in range(1, long_ar + 1)]
    d = differenced(series, key, time, value, long_ar).withColumn("one", F.lit(1.0))
    s1 = solve_by_key(gram_by_key(d, key, xs1, "d"), key, len(xs1))
    pred1 = sum((F.col("coef")[i] * F.col(c) for i, c in enumerate(xs1)), F.lit(0.0))
    w = Window.partitionBy(key).orderBy(time)
    with_e = null_safe_join(d, s1.select(key, "coef"), [key]).withColumn("e", F.col("d") - pred1).drop("coef")
    resid = with_e.select(key, time, "d", "d1", "d2", "one", F.lag("e", 1).over(w).alias("e1"),
                          F.lag("e", 2).over(w).alias("e2"))
    xs2 = ["one", "d1", "d2", "e1", "e2"]
    return with_e, solve_by_key(gram_by_key(resid, key, xs2, "d"), key, len(xs2))


def forecast_arma(series: DataFrame, key: str = "station", time: str = "datetime",
                  value: str = "pm25", horizon: int = FORECAST_HORIZON,
                  long_ar: int = AR_LONG) -> DataFrame:
    """Recursive ``horizon``-step forecast of the level, clipped at 0: key, step, time, yhat.

    Future innovations are 0; the last two differences and residuals seed the recursion,
    which runs as a JVM higher-order function (:func:`arma_recursion`).
    """
    check_horizon(horizon)
    state = arma_state(series, key, time, value, long_ar)
    out = arma_recursion(state, key, horizon)
    return out.withColumnRenamed("datetime", time) if time != "datetime" else out


def arma_recursion(state: DataFrame, key: str, horizon: int) -> DataFrame:
    """h-step recursion from a per-key state (coef, level, last_time, dl1, dl2, el1, el2):
    ``aggregate(sequence(1, h), ...)`` over a struct accumulator, a JVM higher-order
    function (no Python), then ``posexplode`` into (key, step, datetime, yhat)."""
    check_horizon(horizon)
    c = [F.col("coef")[i] for i in range(5)]
    z = F.lit(0.0)
    init = F.struct(F.coalesce(F.col("dl1"), z).alias("d1"), F.coalesce(F.col("dl2"), z).alias("d2"),
                    F.coalesce(F.col("el1"), z).alias("e1"), F.coalesce(F.col("el2"), z).alias("e2"),
                    F.col("level").cast("double").alias("level"),
                    F.array().cast("array<double>").alias("preds"))

    def step(acc, _):
        dh = c[0] + c[1] * acc["d1"] + c[2] * acc["d2"] + c[3] * acc["e1"] + c[4] * acc["e2"]
        level = acc["level"] + dh
        return F.struct(dh.alias("d1"), acc["d1"].alias("d2"), z.alias("e1"), acc["e1"].alias("e2"),
                        level.alias("level"),
                        F.concat(acc["preds"], F.array(F.greatest(level, z))).alias("preds"))

    preds = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["preds"]
    return (state.select(key, "last_time", F.posexplode(preds).alias("pos", "yhat"))
            .select(key, (F.col("pos") + 1).alias("step"),
                    F.timestamp_add("HOUR", F.col("pos") + 1, F.col("last_time")).alias("datetime"),
                    "yhat"))


def arma_state(series: DataFrame, key: str = "station", time: str = "datetime",
               value: str = "pm25", long_ar: int = AR_LONG) -> DataFrame:
    """Per-key forecasting state (coefficients + last level, differences, residuals), the
    table a serving job keeps to answer any horizon without refitting."""
    with_e, coefs = _fit_arma_stages(series, key, time, value, long_ar)
    w = Window.partitionBy(key).orderBy(F.col(time).desc())
    tail = (with_e.withColumn("e", F.coalesce(F.col("e"), F.lit(0.0)))
            .withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= 2))
    seed = tail.groupBy(key).agg(
        F.max_by(value, F.when(F.col("_rk") == 1, F.lit(1))).alias("level"),
        F.max_by(time, F.when(F.col("_rk") == 1, F.lit(1))).alias("last_time"),
        F.max(F.when(F.col("_rk") == 1, F.col("d"))).alias("dl1"),
        F.max(F.when(F.col("_rk") == 2, F.col("d"))).alias("dl2"),
        F.max(F.when(F.col("_rk") == 1, F.col("e"))).alias("el1"),
        F.max(F.when(F.col("_rk") == 2, F.col("e"))).alias("el2"))
    return null_safe_join(seed, coefs.select(key, "coef", F.col("s2").alias("sigma2")), [key])


def serve_forecast(state: DataFrame, horizon: int, key: str = "station",
                   station: str | None = None) -> DataFrame:
    """Forecast request (H17): horizon 1..72 from the saved state, for one station or all."""
    if station is not None:
        state = state.filter(F.col(key) == F.lit(station))
    return arma_recursion(state, key, horizon)


# --- additive model -------------------------------------------------------------------

FOURIER = (("daily", 1.0, 4), ("weekly", 7.0, 3), ("yearly", 365.25, 10))


def fourier_columns(time: str, terms=FOURIER):
    """sin/cos(2 pi k t / P) with t in days since the epoch, for each (name, P, K)."""
    # wall-clock days since 1970-01-01 of a naive timestamp: independent of the session zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    t = F.timestamp_diff("MICROSECOND", epoch, F.col(time)).cast("double") / F.lit(DAY_S * 1e6)
    cols = []
    for name, period, order in terms:
        for k in range(1, order + 1):
            ang = F.lit(2 * math.pi * k / period) * t
            cols += [F.sin(ang).alias(f"{name}_sin{k}"), F.cos(ang).alias(f"{name}_cos{k}")]
    return cols


def fourier_names(terms=FOURIER):
    return [f"{n}_{f}{k}" for n, _, o in terms for k in range(1, o + 1) for f in ("sin", "cos")]


def add_fourier(series: DataFrame, time: str = "datetime", terms=FOURIER) -> DataFrame:
    return series.select("*", *fourier_columns(time, terms))


def _design(df: DataFrame, key: str, time: str, n_changepoints: int, terms) -> DataFrame:
    """Trend (scaled time, hinges at evenly spaced points of the first 80% of each key's
    span) and Fourier terms."""
    b = df.groupBy(key).agg(F.min(time).alias("_t0"), F.max(time).alias("_t1"))
    j = null_safe_join(df, b, [key])
    span = F.greatest(F.timestamp_diff("SECOND", F.col("_t0"), F.col("_t1")).cast("double"), F.lit(1.0))
    s = F.timestamp_diff("SECOND", F.col("_t0"), F.col(time)).cast("double") / span
    cols = [F.lit(1.0).alias("one"), s.alias("trend")]
    for i in range(1, n_changepoints + 1):
        cp = 0.8 * i / (n_changepoints + 1)
        cols.append(F.greatest(s - F.lit(cp), F.lit(0.0)).alias(f"cp{i}"))
    return j.select("*", *cols, *fourier_columns(time, terms))


def forecast_additive(series: DataFrame, key: str = "station", time: str = "datetime",
                      value: str = "pm25", horizon: int = FORECAST_HORIZON,
                      n_changepoints: int = 10, changepoint_prior: float = 0.05,
                      season_prior: float = 10.0, terms=FOURIER,
                      interval: float = 0.8) -> DataFrame:
    """Penalised least-squares additive model per key, ``horizon`` steps ahead, with a
    band from residual quantiles (``interval`` coverage). Output: key, step, time, yhat,
    yhat_lower, yhat_upper (all clipped at 0)."""
    check_horizon(horizon)
    names = ["one", "trend"] + [f"cp{i}" for i in range(1, n_changepoints + 1)] + fourier_names(terms)
    x = _design(series, key, time, n_changepoints, terms)
    # Gaussian priors as ridge weights: tight on changepoint deltas, loose on seasonality
    pen = ([0.0, 0.0] + [1.0 / changepoint_prior ** 2] * n_changepoints
           + [1.0 / season_prior ** 2] * len(fourier_names(terms)))
    coefs = solve_by_key(gram_by_key(x, key, names, value), key, len(names), pen)
    fitted = sum((F.col("coef")[i] * F.col(c) for i, c in enumerate(names)), F.lit(0.0))
    resid = null_safe_join(x, coefs.select(key, "coef"), [key]).select(key, (F.col(value) - fitted).alias("r"))
    lo_q, hi_q = (1 - interval) / 2, 1 - (1 - interval) / 2
    band = resid.groupBy(key).agg(F.percentile_approx("r", [lo_q, hi_q], 10000).alias("_q"))
    b = series.groupBy(key).agg(F.min(time).alias("_t0"), F.max(time).alias("_t1"))
    fut = (b.select(key, "_t0", "_t1", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
           .withColumn(time, F.timestamp_add("HOUR", F.col("step"), F.col("_t1"))))
    span = F.greatest(F.timestamp_diff("SECOND", F.col("_t0"), F.col("_t1")).cast("double"), F.lit(1.0))
    s = F.timestamp_diff("SECOND", F.col("_t0"), F.col(time)).cast("double") / span
    fut = fut.select(key, "step", time, F.lit(1.0).alias("one"), s.alias("trend"),
                     *[F.greatest(s - F.lit(0.8 * i / (n_changepoints + 1)), F.lit(0.0)).alias(f"cp{i}")
                       for i in range(1, n_changepoints + 1)],
                     *fourier_columns(time, terms))
    pred = null_safe_join(null_safe_join(fut, coefs.select(key, "coef"), [key]), band, [key])
    return pred.select(key, "step", time, clip(fitted, 0.0).alias("yhat"),
                       clip(fitted + F.col("_q")[0], 0.0).alias("yhat_lower"),
                       clip(fitted + F.col("_q")[1], 0.0).alias("yhat_upper"))


def holdout_metrics(actual: DataFrame, forecast: DataFrame, key: str = "station",
                    time: str = "datetime", value: str = "pm25") -> DataFrame:
    """RMSE and MAE per key of a forecast against the held-out actual values."""
    j = null_safe_join(forecast, actual.select(key, time, value), [key, time])
    e = F.col("yhat") - F.col(value)
    return j.groupBy(key).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))
