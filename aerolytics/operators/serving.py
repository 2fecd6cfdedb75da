"""Serving forecasts from saved states with prediction bands.

A training run holds out the last hours of every series, scores the forecasters on them,
keeps the winner of each series and saves the state of that model, refitted on the whole
series. A request reads the states and extrapolates: nothing is fitted, and every horizon
up to the limit comes from one row per series. Each model is linear in its parameters, so
the variance of a forecast follows from the state:

* seasonal means: ``s2 (1 + 1/n)`` with the readings of the weekday-hour;
* additive model: ``s2 (1 + x' (X'X + P)^-1 x)`` for the design row ``x`` of the hour;
* ARIMA(2,1,2): ``s2`` times the running sum of squared impulse weights of the level.

Bands are ``z`` standard deviations on both sides; forecasts and bands are clipped at 0 and
rounded to 2 places. A NULL station is a series like others; series without a winner (no
forecast could be scored) are served by the first model.
"""

from __future__ import annotations

import json
import math
from statistics import NormalDist

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolytics.constants import FORECAST_HORIZON
from aerolytics.operators import forecast as fc
from aerolytics.operators import sampling
from aerolytics.operators.joins import null_safe_join
from aerolytics.operators.storage import stored

INTERVAL = 0.8


def design_names(n_changepoints: int, terms) -> list[str]:
    return ["one", "trend"] + [f"cp{i}" for i in range(1, n_changepoints + 1)] + fc.fourier_names(terms)


def _design_row(time: str, n_changepoints: int, terms) -> list[Column]:
    """The design columns of an hour from the state's ``t0`` and ``t1``."""
    span = F.greatest(F.timestamp_diff("SECOND", F.col("t0"), F.col("t1")).cast("double"), F.lit(1.0))
    s = F.timestamp_diff("SECOND", F.col("t0"), F.col(time)).cast("double") / span
    hinges = [F.greatest(s - F.lit(0.8 * i / (n_changepoints + 1)), F.lit(0.0)) for i in range(1, n_changepoints + 1)]
    return [F.lit(1.0), s, *hinges, *fc.fourier_columns(time, terms)]


def additive_state(series: DataFrame, key: str = "station", time: str = "datetime", value: str = "pm25",
                   n_changepoints: int = 10, changepoint_prior: float = 0.05, season_prior: float = 10.0,
                   terms=fc.FOURIER) -> DataFrame:
    """Per key: span, coefficients, inverse, residual variance and the design they belong to."""
    names = design_names(n_changepoints, terms)
    spans = series.groupBy(key).agg(F.min(time).alias("t0"), F.max(time).alias("t1"))
    x = null_safe_join(series.select(key, time, value), spans, [key])
    x = x.select(key, value, *[c.alias(n) for c, n in zip(_design_row(time, n_changepoints, terms), names)])
    pen = [0.0, 0.0] + [changepoint_prior ** -2] * n_changepoints + [season_prior ** -2] * len(fc.fourier_names(terms))
    fitted = fc.solve_by_key(fc.gram_by_key(x, key, names, value), key, len(names), pen)
    design = json.dumps({"n_changepoints": n_changepoints, "terms": [list(t) for t in terms]})
    return null_safe_join(fitted, spans, [key]).withColumn("design", F.lit(design))


def _steps(state: DataFrame, key: str, last: str, horizon: int) -> DataFrame:
    return state.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")) \
        .withColumn("at", F.timestamp_add("HOUR", F.col("step"), F.col(last)))


def serve_seasonal(state: DataFrame, key: str, horizon: int) -> DataFrame:
    rows = _steps(state, key, "last_time", horizon).withColumn("_c", fc._cell("at"))
    return rows.select(key, "step", "at", F.col("_c.mean").alias("yhat"),
                       (F.col("s2") * (1 + 1 / F.col("_c.n"))).alias("var"))


def serve_additive(state: DataFrame, key: str, horizon: int) -> DataFrame:
    first = state.select("design").first()
    if first is None:
        return state.sparkSession.createDataFrame([], f"{key} {state.schema[key].dataType.simpleString()}, "
                                                  "step int, at timestamp_ntz, yhat double, var double")
    d = json.loads(first["design"])
    x = _design_row("at", d["n_changepoints"], [tuple(t) for t in d["terms"]])
    p = len(x)
    rows = _steps(state, key, "t1", horizon).withColumn("x", F.array(*x))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)

    spread = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.element_at("x", i + 1)
                                     * dot(F.slice("inv", i * p + 1, F.lit(p)), F.col("x"))), F.lit(0.0), lambda acc, v: acc + v)
    return rows.select(key, "step", "at", dot(F.col("coef"), F.col("x")).alias("yhat"), (F.col("s2") * (1 + spread)).alias("var"))


def serve_arima(state: DataFrame, key: str, horizon: int) -> DataFrame:
    """The recursion of the level, and of its impulse weights: those of the difference are
    1, phi1 + theta1, phi1 psi1 + phi2 + theta2, then phi1 psi' + phi2 psi''."""
    c = [F.col("coef")[i] for i in range(5)]
    z = F.lit(0.0)
    init = F.struct(F.coalesce("dl1", z).alias("d1"), F.coalesce("dl2", z).alias("d2"), F.coalesce("el1", z).alias("e1"),
                    F.coalesce("el2", z).alias("e2"), F.col("level").cast("double").alias("level"), z.alias("p1"), z.alias("p2"),
                    z.alias("sum"), z.alias("var"), F.array().cast("array<struct<y:double,v:double>>").alias("out"))

    def step(a, h):
        d = c[0] + c[1] * a["d1"] + c[2] * a["d2"] + c[3] * a["e1"] + c[4] * a["e2"]
        level = a["level"] + d
        psi = F.when(h == 1, F.lit(1.0)).when(h == 2, c[1] + c[3]).when(h == 3, c[1] * a["p1"] + c[2] + c[4]) \
            .otherwise(c[1] * a["p1"] + c[2] * a["p2"])
        total = a["sum"] + psi
        var = a["var"] + total * total
        return F.struct(d.alias("d1"), a["d1"].alias("d2"), z.alias("e1"), a["e1"].alias("e2"), level.alias("level"),
                        psi.alias("p1"), a["p1"].alias("p2"), total.alias("sum"), var.alias("var"),
                        F.concat(a["out"], F.array(F.struct(level.alias("y"), var.alias("v")))).alias("out"))

    out = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["out"]
    return state.select(key, "last_time", "sigma2", F.posexplode(out).alias("pos", "o")).select(
        key, (F.col("pos") + 1).alias("step"), F.timestamp_add("HOUR", F.col("pos") + 1, F.col("last_time")).alias("at"),
        F.col("o.y").alias("yhat"), (F.col("sigma2") * F.col("o.v")).alias("var"))


#: name: (state of a series table, forecasts of a state), in the order that decides ties
FORECASTERS = {"seasonal": (fc.seasonal_state, serve_seasonal), "arima": (fc.arma_state, serve_arima),
               "additive": (additive_state, serve_additive)}


def holdout_scores(series: DataFrame, key: str = "station", time: str = "datetime", value: str = "pm25",
                   horizon: int = FORECAST_HORIZON, forecasters=None) -> tuple[DataFrame, DataFrame]:
    """RMSE and MAE of every forecaster on the last ``horizon`` rows of each series, and the
    series that are too short to be scored with their number of rows."""
    forecasters = forecasters or FORECASTERS
    flagged, rejected = sampling.holdout_tail(series, key, time, horizon)
    flagged = stored(flagged, "holdout")                 # one split, read by every forecaster
    train, test = flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")
    out = None
    for order, (name, (state, forecast)) in enumerate(forecasters.items(), start=1):
        pred = forecast(state(train, key, time, value), key, horizon).select(
            key, F.col("at").alias(time), F.greatest("yhat", F.lit(0.0)).alias("yhat"))
        m = fc.holdout_metrics(test, pred, key, time, value).select(
            key, F.lit(name).alias("model"), F.lit(order).alias("trained_order"), "rmse", "mae")
        out = m if out is None else out.unionAll(m)
    return out, rejected


def choose(scores: DataFrame, key: str = "station") -> DataFrame:
    """The model of least RMSE per series; ties go to the model trained first."""
    worth = F.struct(F.coalesce(F.nanvl("rmse", F.lit(math.inf)), F.lit(math.inf)), F.col("trained_order"))
    return scores.groupBy(key).agg(F.min_by("model", worth).alias("model"))


def save_states(series: DataFrame, winners: DataFrame, path: str, key: str = "station", time: str = "datetime",
                value: str = "pm25", forecasters=None) -> None:
    """Write the winners and, for each model, the states of the series it won (refitted on all
    their rows). Series without a winner get the first model."""
    forecasters = forecasters or FORECASTERS
    keys = series.select(key).distinct()
    every = null_safe_join(keys, winners, [key], "left").select(key, F.coalesce("model", F.lit(next(iter(forecasters)))).alias("model"))
    every.write.mode("overwrite").parquet(f"{path}/winner")
    stored = series.sparkSession.read.parquet(f"{path}/winner")
    for name, (state, _) in forecasters.items():
        mine = null_safe_join(series, stored.where(F.col("model") == name).select(key), [key])
        state(mine, key, time, value).write.mode("overwrite").parquet(f"{path}/state_{name}")


def forecast_request(spark: SparkSession, path: str, horizon: int = FORECAST_HORIZON, key: str = "station",
                     station=None, interval: float = INTERVAL, forecasters=None) -> DataFrame:
    """Forecasts from the saved states: key, model, step, datetime, prediction, lower, upper;
    ``station`` limits the request to one series, an unknown one gives no rows."""
    fc.check_horizon(horizon)
    z = NormalDist().inv_cdf((1 + interval) / 2)
    out = None
    for name, (_, forecast) in (forecasters or FORECASTERS).items():
        try:
            state = spark.read.parquet(f"{path}/state_{name}")
        except AnalysisException as e:                   # a model that was not saved
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if station is not None:
            state = state.where(F.col(key) == F.lit(station))
        half = F.lit(z) * F.sqrt("var")
        rows = forecast(state, key, horizon).select(
            key, F.lit(name).alias("model"), "step", F.col("at").alias("datetime"),
            *[F.round(F.greatest(c, F.lit(0.0)), 2).alias(n) for c, n in (
                (F.col("yhat"), "prediction"), (F.col("yhat") - half, "lower"), (F.col("yhat") + half, "upper"))])
        out = rows if out is None else out.unionAll(rows)
    if out is None:
        raise FileNotFoundError(f"no forecaster state below {path}")
    return out
