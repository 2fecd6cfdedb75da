"""Hand-computed frames (edge cases) and closed-form checks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolytics.operators import clean, evaluate, profiles, resample
from aerolytics.operators.models import ridge_reg_param
from aerolytics.functions.aqi import aqi_category


def test_interpolation_hourly(spark):
    rows = [("s", dt.datetime(2024, 1, 1, 0, 10), 1.0), ("s", dt.datetime(2024, 1, 1, 1, 0), 2.0),
            ("s", dt.datetime(2024, 1, 1, 5, 30), 4.0)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")
    got = [r.pm25 for r in resample.prepare_series(df).orderBy("datetime").collect()]
    assert got == pytest.approx([1, 2, 2.5, 3, 3.5, 4])


def test_week_label_sunday(spark):
    rows = [("s", dt.datetime(2024, 1, 7, 23), 10.0), ("s", dt.datetime(2024, 1, 8, 0), -5.0),
            ("s", dt.datetime(2024, 1, 22, 0), 3.333)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")
    got = [(r.week_end, r.mean) for r in resample.resample_weekly(df).orderBy("week_end").collect()]
    # the negative is clipped to 0 before the mean; the empty week in between is 0
    assert got == [("2024-01-07", 10.0), ("2024-01-14", 0.0), ("2024-01-21", 0.0), ("2024-01-28", 3.33)]


def test_median_with_null(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "v double")
    assert [r.v for r in clean.impute_median(df, ["v"]).collect()] == [1.0, 4.0, 2.5]


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([("NE",), ("E",), ("N",), ("ENE",), (None,)], "wd string")
    got = {r.wd: r.code for r in clean.label_encode(df, "wd", "code", null_as="N").collect()}
    assert got == {"E": 0, "ENE": 1, "N": 2, "NE": 3, None: 2}


def test_scalers_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert [r.x for r in clean.scale_minmax(df, ["x"]).collect()] == [0.0, 0.0, 0.0]
    assert [r.x for r in clean.scale_standard(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_ffill_median_clip(spark):
    rows = [("s", dt.datetime(2024, 1, 1, h), v) for h, v in enumerate([None, -4.0, None, 6.0])]
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")
    out = clean.impute_ffill_median(df, ["pm25"], clip_cols=["pm25"])
    assert [r.pm25 for r in out.orderBy("datetime").collect()] == [1.0, 0.0, 0.0, 6.0]
    out_nc = clean.impute_ffill_median(df, ["pm25"], clip_cols=[])
    assert [r.pm25 for r in out_nc.orderBy("datetime").collect()] == [1.0, -4.0, -4.0, 6.0]


def test_null_pm25_is_hazardous_by_default(spark):
    df = spark.createDataFrame([(None,)], "pm25 double")
    assert df.select(aqi_category("pm25")).first()[0] == "Hazardous"
    assert df.select(aqi_category("pm25", null_label=None)).first()[0] is None


def test_reference_label_literals(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 25, 50, 100, 200, 300]], "pm25 double")
    got = [r[0] for r in df.select(aqi_category("pm25")).collect()]
    assert got[0] == "Good" and got[1] == "Moderate" and got[5] == "Hazardous"


def test_recommend_unknown_station_and_ties(spark):
    prof = spark.createDataFrame([("A", h, 0.5) for h in range(24)], "station string, hour int, safety_score double")
    top = profiles.recommend_windows(prof, top_n=3, station="a").collect()
    assert [r.hour for r in top] == [0, 1, 2]
    assert top[0].time_label == "00:00 – 01:00" and top[0].advice.endswith("Moderate")
    assert profiles.recommend_windows(prof, 3, station="nowhere").count() == 0
    with pytest.raises(ValueError):
        profiles.recommend_windows(prof, 25)


def test_macro_f1_union_of_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    row = evaluate.classification_metrics(df).first()
    # classes {0,1,2}: f1 = [2/3, 2/4, 0] -> mean 7/18
    assert row.accuracy == pytest.approx(0.5)
    assert row.f1_macro == pytest.approx((2 / 3 + 0.5 + 0) / 3)


def test_ridge_matches_closed_form(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    lr = LinearRegression(featuresCol="features", labelCol="y", elasticNetParam=0.0,
                          regParam=ridge_reg_param(df, "y", 1.0), standardization=False, solver="normal")
    m = lr.fit(data)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 1.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-9)
    assert m.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-9)


def test_quality_required_columns_and_rules(spark):
    from aerolytics.operators import quality
    df = spark.createDataFrame([("s", 1.0, 0), ("s", None, 7)], "station string, pm25 double, aqi_label int")
    assert quality.require_columns(df, ["station", "pm25", "wd"]) == ["wd"]
    rep = {(r.rule, r.column): r for r in quality.quality_report(df, ["pm25"], label="aqi_label").collect()}
    assert rep[("null_rate", "pm25")].observed == 0.5 and not rep[("null_rate", "pm25")].passed
    assert rep[("label_range", "aqi_label")].observed == 1.0


def test_silhouette_and_ch_match_numpy(spark):
    from aerolytics.operators import clusters
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(c, 0.3, size=(15, 2)) for c in (0, 3, 6)])
    lab = np.repeat([0, 1, 2], 15)
    df = spark.createDataFrame([(i, float(a), float(b), int(l)) for i, ((a, b), l) in enumerate(zip(pts, lab))],
                               "id int, x double, y double, cluster int")
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(pts)):
        own = lab == lab[i]
        a = d2[i, own & (np.arange(len(pts)) != i)].mean()
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = clusters.silhouette_sq(df, ["x", "y"], "id").first()[0]
    assert got == pytest.approx(np.mean(s), rel=1e-9)
    mu = pts.mean(0)
    bsum = sum(15 * ((pts[lab == c].mean(0) - mu) ** 2).sum() for c in range(3))
    wsum = sum(((pts[lab == c] - pts[lab == c].mean(0)) ** 2).sum() for c in range(3))
    ch = clusters.calinski_harabasz(df, ["x", "y"]).first()[0]
    assert ch == pytest.approx((bsum / 2) / (wsum / (45 - 3)), rel=1e-9)


def test_model_save_load_and_profile_assignment(spark, tmp_path):
    from pyspark.ml.clustering import KMeans
    from aerolytics.operators import clusters, models
    df = spark.createDataFrame([(i, float(i % 3) * 10 + 0.1 * i, float(i % 3)) for i in range(30)],
                               "id int, a double, b double")
    pipe = models.make_pipeline(["a"], models.regressors("b", 0.0)[2][1])
    m = pipe.fit(df)
    models.save_model(m, str(tmp_path / "m"))
    back = models.load_model(str(tmp_path / "m"))
    assert back is not None and models.load_model(str(tmp_path / "none")) is None
    a = sorted(r.prediction for r in m.transform(df).collect())
    b = sorted(r.prediction for r in back.transform(df).collect())
    assert a == pytest.approx(b)
    stats = df.agg(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    mean, std = [stats[0], stats[2]], [stats[1], stats[3]]
    from aerolytics.operators.clean import scale_standard
    z = clusters.with_vector(scale_standard(df, ["a", "b"]), ["a", "b"])
    km = KMeans(k=3, seed=1).fit(z)
    got = clusters.assign_profile([c.tolist() for c in km.clusterCenters()], df, ["a", "b"], "id", mean, std)
    want = km.transform(z).select("id", F.col("prediction").alias("cluster"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        clusters.assign_profile([[0, 0]], df.select("id", "a"), ["a", "b"], "id", mean, std)
    padded = clusters.assign_profile([[0, 0]], df.select("id", "a"), ["a", "b"], "id", mean, std, pad=True)
    assert padded.count() == 30


def test_station_request_allow_list(spark):
    rows = [("Aotizhongxin", dt.datetime(2024, 1, 1, 3), 5.0), ("Dongsi", dt.datetime(2024, 1, 1, 3), 9.0)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")
    from aerolytics.constants import STATIONS
    got = resample.station_weekly_series(df, "Aotizhongxin", STATIONS).collect()
    assert [(r.station, r.week_end, r.mean) for r in got] == [("Aotizhongxin", "2024-01-07", 5.0)]
    with pytest.raises(ValueError):
        resample.station_weekly_series(df, "../../etc/passwd", STATIONS)


def test_pca_variance_and_signs(spark):
    from aerolytics.operators import projection
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 1))
    x = np.hstack([base, 2 * base + rng.normal(scale=0.1, size=(300, 1)), rng.normal(size=(300, 1))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    z = (x - x.mean(0)) / x.std(0)
    vals = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    comps, ratio, n = projection.fit_pca(clean.scale_standard(df, ["a", "b", "c"]), ["a", "b", "c"])
    assert ratio == pytest.approx(vals / vals.sum(), rel=1e-9)
    assert n == int(np.searchsorted(np.cumsum(vals / vals.sum()), 0.95, side="right") + 1)
    for k in range(3):
        assert comps[np.argmax(np.abs(comps[:, k])), k] > 0


def test_psi_and_ks_detect_shift(spark):
    from aerolytics.operators import quality
    rng = np.random.default_rng(9)
    base = rng.normal(size=4000)
    rows = [("x", float(v), i >= 2000) for i, v in enumerate(base)]
    rows += [("y", float(v) + (1.0 if i >= 2000 else 0.0), i >= 2000) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "feature string, value double, is_test boolean")
    psi = {r.feature: r.psi for r in quality.drift_psi(df).collect()}
    ks = {r.feature: r.ks for r in quality.drift_ks(df).collect()}
    assert psi["x"] < 0.05 < 0.5 < psi["y"]
    assert ks["x"] < 0.06 and ks["y"] > 0.3


def test_label_encode_ranks_any_type(spark):
    d = spark.range(1000).select((F.col("id") * 7 % 301 - 50).alias("i"),
                                 F.concat(F.lit("é"), (F.col("id") % 97).cast("string")).alias("s"))
    for c in ("i", "s"):
        rows = clean.label_encode(d, c, "code").collect()
        order = sorted({r[c] for r in rows}, key=lambda v: v.encode() if isinstance(v, str) else v)
        assert len(rows) == 1000 and all(r.code == order.index(r[c]) for r in rows)

def test_map_points_nulls_radius_and_quirk(spark):
    from aerolytics.operators import maps
    df = spark.createDataFrame([(None, "C", 1.0, 2.0, "300", "Hazardous"),
                                ("X", "C", 0.0, 2.0, "20", "Good"),
                                ("Y", None, 3.0, None, None, None)],
                               "City string, Country string, lat double, lng double, `AQI Value` string, `AQI Category` string")
    pts = maps.map_points(df, mappable_only=False).orderBy("lat").collect()
    assert [p.city for p in pts] == ["X", "Unknown", "Y"]
    assert [p.radius for p in pts] == [4.0, 15.0, 4.0]  # clamp(aqi / 10, 4, 15)
    assert pts[2].aqi_category == "Unknown" and pts[2].lng == 0.0
    assert maps.map_points(df, text_null="0").first().city == "0"  # reference quirk, opt-in
    s = maps.map_summary(maps.map_points(df, mappable_only=False)).first()
    assert (s.total_points, s.mappable_points, s.hazardous_points) == (3, 1, 1)
