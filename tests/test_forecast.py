"""Forecasting stages: Gram aggregates, coefficient recovery, additive fit on seasonal data."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolytics.operators import forecast, sampling


def _series(spark, values_by_key, start=dt.datetime(2024, 1, 1)):
    rows = [(k, start + dt.timedelta(hours=i), float(v))
            for k, vals in values_by_key.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")


def test_gram_matches_numpy_with_flushing(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for k in range(40):
        x = rng.normal(size=(25, 3))
        y = x @ np.array([1.0, -2.0, 0.5]) + k
        rows += [(k, *map(float, xi), float(yi)) for xi, yi in zip(x, y)]
        want[k] = (x.T @ x, x.T @ y, len(y))
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, y double").repartition(3)
    got = forecast.gram_by_key(df, "k", ["a", "b", "c"], "y", max_open_keys=1).collect()
    assert len(got) == 40
    for r in got:
        xtx, xty, n = want[r.k]
        assert np.allclose(np.array(r.xtx).reshape(3, 3), xtx) and np.allclose(r.xty, xty) and r.n == n
    coef = {r.k: r.coef for r in forecast.solve_by_key(
        forecast.gram_by_key(df, "k", ["a", "b", "c"], "y"), "k", 3).collect()}
    # no intercept column: coefficients absorb the per-key offset, but key 0 is exact
    assert coef[0] == pytest.approx([1.0, -2.0, 0.5], abs=1e-9)


def test_arma_recovers_known_coefficients(spark):
    rng = np.random.default_rng(11)
    phi, theta = (0.5, -0.3), (0.4, 0.2)
    n = 6000
    e = rng.normal(size=n + 2)
    d = np.zeros(n + 2)
    for t in range(2, n + 2):
        d[t] = phi[0] * d[t - 1] + phi[1] * d[t - 2] + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
    level = 500 + np.cumsum(d[2:])
    coef = forecast.fit_arma(_series(spark, {"s": level})).first().coef
    c, p1, p2, t1, t2 = coef
    assert abs(c) < 0.1
    assert p1 == pytest.approx(phi[0], abs=0.1) and p2 == pytest.approx(phi[1], abs=0.1)
    assert t1 == pytest.approx(theta[0], abs=0.1) and t2 == pytest.approx(theta[1], abs=0.1)
    fc = forecast.forecast_arma(_series(spark, {"s": level}), horizon=5).orderBy("step").collect()
    assert [r.step for r in fc] == [1, 2, 3, 4, 5] and all(r.yhat >= 0 for r in fc)
    with pytest.raises(ValueError):
        forecast.forecast_arma(_series(spark, {"s": level}), horizon=73)


def test_additive_fits_daily_season_better_than_baseline(spark):
    rng = np.random.default_rng(2)
    h = np.arange(24 * 40)
    vals = 50 + 0.01 * h + 15 * np.sin(2 * np.pi * h / 24) + rng.normal(scale=1.0, size=len(h))
    s = _series(spark, {"a": vals, "b": vals * 0.5 + 10})
    flagged, rejected = sampling.holdout_tail(s, "station", "datetime", 24)
    assert rejected.count() == 0
    train = flagged.filter(~F.col("is_test")).drop("is_test")
    test = flagged.filter(F.col("is_test")).drop("is_test")
    add = {r.station: r.rmse for r in forecast.holdout_metrics(test, forecast.forecast_additive(train)).collect()}
    base = {r.station: r.rmse for r in forecast.holdout_metrics(test, forecast.forecast_seasonal(train)).collect()}
    assert set(add) == {"a", "b"}
    assert add["a"] < 3.0 and add["a"] <= base["a"]
    band = forecast.forecast_additive(train).collect()
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in band)


# --- states and bands ---------------------------------------------------------------

def _bands(state, serve, horizon=5):
    return {(r["station"], r["step"]): (r["yhat"], r["var"]) for r in serve(state, "station", horizon).collect()}


def test_additive_bands_equal_the_closed_form(spark):
    from aerolytics.operators import serving
    rng = np.random.default_rng(7)
    h = np.arange(24 * 12)
    y = 40 + 0.02 * h + 5 * np.sin(2 * np.pi * h / 24) + rng.normal(size=len(h))
    terms, cps = (("daily", 1.0, 2),), 2
    got = _bands(serving.additive_state(_series(spark, {"a": y, None: y + 1}), n_changepoints=cps, terms=terms), serving.serve_additive)
    days = (np.datetime64("2024-01-01") - np.datetime64("1970-01-01")).astype(float)

    def design(i):
        s = i / h[-1]
        cols = [np.ones_like(s), s] + [np.maximum(s - 0.8 * k / (cps + 1), 0) for k in range(1, cps + 1)]
        t = days + i / 24
        for k in (1, 2):
            cols += [np.sin(2 * np.pi * k * t), np.cos(2 * np.pi * k * t)]
        return np.stack(cols, axis=1)

    x = design(h.astype(float))
    pen = np.diag([0, 0] + [400.0] * cps + [0.01] * 4)
    inv = np.linalg.inv(x.T @ x + pen)
    b = inv @ x.T @ y
    s2 = ((y - x @ b) ** 2).sum() / (len(y) - x.shape[1])
    f = design(h[-1] + np.arange(1.0, 6))
    for step in range(1, 6):
        want = (f[step - 1] @ b, s2 * (1 + f[step - 1] @ inv @ f[step - 1]))
        assert got["a", step] == pytest.approx(want, rel=1e-6)
        assert got[None, step][0] == pytest.approx(want[0] + 1, rel=1e-3)      # a NULL station is served too


def test_arima_bands_equal_the_impulse_weights(spark):
    from aerolytics.operators import serving
    c, p1, p2, t1, t2 = coef = [0.1, 0.5, -0.3, 0.4, 0.2]
    state = spark.createDataFrame([("s", coef, 2.0, 50.0, dt.datetime(2024, 1, 1), 1.0, -1.0, 0.5, 0.25)],
                                  "station string, coef array<double>, sigma2 double, level double, last_time timestamp_ntz, "
                                  "dl1 double, dl2 double, el1 double, el2 double")
    got = _bands(state, serving.serve_arima, 72)
    psi = [1.0, p1 + t1, p1 * (p1 + t1) + p2 + t2]
    while len(psi) < 72:
        psi.append(p1 * psi[-1] + p2 * psi[-2])
    var = 2.0 * np.cumsum(np.cumsum(psi) ** 2)
    d, e, level = [-1.0, 1.0], [0.25, 0.5], 50.0
    for h in range(1, 73):
        d.append(c + p1 * d[-1] + p2 * d[-2] + t1 * e[-1] + t2 * e[-2])
        e.append(0.0)
        level += d[-1]
        assert got["s", h] == pytest.approx((level, var[h - 1]))


def test_unseen_weekday_hours_fall_back(spark):
    s = _series(spark, {"a": range(30), None: [5.0] * 30})          # 30 hours: most weekday-hours unseen
    out = {(r["station"], r["step"]): r["yhat"] for r in forecast.forecast_seasonal(s, horizon=30).collect()}
    assert out["a", 1] == 6.0                                       # only Monday 06:00 is known at that hour
    assert all(v is not None for v in out.values()) and out[None, 30] == 5.0
    short = _series(spark, {"a": [1.0, 3.0]})
    assert [r["yhat"] for r in forecast.forecast_seasonal(short, horizon=2).collect()] == [2.0, 2.0]


def test_best_forecaster_is_served(spark, tmp_path):
    from aerolytics.operators import serving
    rng = np.random.default_rng(3)
    h = np.arange(24 * 21)
    day = 30 + 20 * np.sin(2 * np.pi * h / 24)
    s = _series(spark, {"daily": day + rng.normal(size=len(h)) * 0.1, "walk": 500 + np.cumsum(rng.normal(size=len(h))), None: day})
    scores, rejected = serving.holdout_scores(s)
    assert rejected.count() == 0 and scores.count() == 9
    best = {r["station"]: r["model"] for r in serving.choose(scores).collect()}
    low = {}
    for r in scores.collect():
        low[r["station"]] = min(low.get(r["station"], (9e9, 9)), (r["rmse"], r["trained_order"]))
    assert {k: list(serving.FORECASTERS)[o - 1] for k, (_, o) in low.items()} == best
    path = str(tmp_path / "states")
    serving.save_states(s, serving.choose(scores), path)
    out = serving.forecast_request(spark, path, 72).collect()
    assert len(out) == 3 * 72 and {(r["station"], r["model"]) for r in out} == set(best.items())
    assert all(0 <= r["lower"] <= r["prediction"] <= r["upper"] for r in out)
    assert serving.forecast_request(spark, path, 3, station="daily").count() == 3
    assert serving.forecast_request(spark, path, 3, station="nowhere").count() == 0
    with pytest.raises(ValueError):
        serving.forecast_request(spark, path, 73)
    with pytest.raises(FileNotFoundError):
        serving.forecast_request(spark, str(tmp_path / "none"), 3)
