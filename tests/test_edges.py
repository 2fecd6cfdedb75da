"""NULL keys, tied times, string keys, degenerate metrics, CSV columns by name."""

import math

import pytest
from pyspark.sql import functions as F

from aerolytics.operators import clusters, evaluate, keyed, quality, resample, sampling
from aerolytics.sources import files


def keyed_rows(spark, n=200):
    return spark.range(n).select(
        F.when(F.col("id") % 4 != 0, (F.col("id") % 3).cast("string")).alias("k"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0,0,0,0,cast(id div 2 as int))").alias("t"),
        F.col("id").alias("i"), (F.col("id") * 1.5).alias("v"))


def test_null_keys_stay(spark):
    d = keyed_rows(spark)
    assert sampling.split_time(d, "k", "t").count() == 200
    assert sampling.split_stratified(d, "k", "i").count() == 200
    flagged, rejected = sampling.holdout_tail(d, "k", "t", horizon=7)
    by = {r["k"]: (r["n"], r["test"]) for r in flagged.groupBy("k").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("test")).collect()}
    assert sum(n for n, _ in by.values()) == 200 and all(t == 7 for _, t in by.values()) and None in by
    assert rejected.count() == 0


def test_null_keys_in_both_forms(spark):
    d = keyed_rows(spark).select("k", "i", F.lit(1).alias("c"))
    a = keyed.running_totals(d, ["k"], "i", ["c"], mode="plain")
    b = keyed.running_totals(d, ["k"], "i", ["c"], mode="bucketed")
    cols = ["k", "i", "cum_c", "tot_c"]
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))
    x = keyed.median_by_key(keyed_rows(spark), ["k"], "v", mode="aggregate").collect()
    y = keyed.median_by_key(keyed_rows(spark), ["k"], "v", mode="bucketed").collect()
    assert sorted(map(str, x)) == sorted(map(str, y))


def test_interpolation_of_long_series(spark):
    d = spark.range(30_000).select(F.lit("s").alias("station"), F.expr(
        "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0,0,0,0,cast(id as int))").alias("datetime"),
        F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).alias("pm25"), "id")
    out = resample.interpolate_linear(d)
    assert out.where(F.abs(F.col("pm25") - F.least("id", F.lit(29990))) > 1e-6).count() == 0


def test_resampling_fills_gaps(spark):
    d = spark.createDataFrame([("a", "2020-01-01 00:10:00", 1.0), ("a", "2020-01-01 03:30:00", 4.0),
                               ("b", "2020-01-01 00:00:00", 7.0)], "station string, s string, pm25 double") \
        .select("station", F.col("s").cast("timestamp_ntz").alias("datetime"), "pm25")
    got = sorted((r["station"], r["datetime"].hour, r["pm25"]) for r in resample.resample_hourly(d).collect())
    assert got[0] == ("a", 0, 1.0) and [x[1] for x in got if x[0] == "a"] == [0, 1, 2, 3]
    assert got[3] == ("a", 3, 4.0) and got[4] == ("b", 0, 7.0) and got[1][2] is None


def test_dbscan_of_named_points(spark):
    pts = spark.createDataFrame([(f"p{i}", float(i // 5 * 10) + i % 5 * 0.1, 0.0) for i in range(10)]
                                + [("alone", 99.0, 9.0)], "name string, x double, y double")
    got = dict(clusters.dbscan(pts, ["x", "y"], "name", eps=0.5, min_points=2).collect())
    assert {got[f"p{i}"] for i in range(5)} == {0} and {got[f"p{i}"] for i in range(5, 10)} == {1} and got["alone"] == -1
    chain = spark.createDataFrame([(i, i * 0.4, 0.0) for i in range(61)], "name long, x double, y double")
    assert clusters.dbscan(chain, ["x", "y"], "name", eps=0.5, min_points=2).select("cluster_dbscan").distinct().count() == 1
    with pytest.raises(RuntimeError):
        clusters.dbscan(chain, ["x", "y"], "name", eps=0.5, min_points=2, max_rounds=2)


def test_degenerate_metrics(spark):
    d = spark.createDataFrame([(2.0, 4.0), (2.0, None), (2.0, 4.0)], "y double, p double")
    r = evaluate.regression_metrics(d).first()
    assert r["rmse"] == 2.0 and r["mae"] == 2.0 and r["r2"] == 0.0
    assert evaluate.regression_metrics(d.limit(0)).first()["rmse"] is None
    same = spark.createDataFrame([(1.0,), (1.0,)], "residual double")
    assert evaluate.moments(same).first()["skewness"] is None
    one = spark.createDataFrame([("f", 1.0, False), ("f", 2.0, False)], "feature string, value double, is_test boolean")
    assert quality.drift_ks(one).first()["ks"] is None and quality.drift_psi(one).first()["psi"] is None
    pts = spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, cluster int")
    assert clusters.calinski_harabasz(pts, ["x"]).first()[0] is None


def test_psi_quantiles_are_exact(spark):
    d = spark.range(1000).select(F.lit("f").alias("feature"), (F.col("id") * F.col("id") % 977).cast("double").alias("value"),
                                 (F.col("id") % 5 == 0).alias("is_test"))
    vals = sorted(r["value"] for r in d.where("not is_test").collect())
    edges = [vals[math.floor(p)] + (vals[math.ceil(p)] - vals[math.floor(p)]) * (p % 1)
             for p in ((len(vals) - 1) * i / 10 for i in range(1, 10))]
    rows = d.collect()
    n = [sum(r["is_test"] == s for r in rows) for s in (False, True)]
    psi = 0.0
    for b in range(10):
        inside = [sum(r["is_test"] == s and sum(r["value"] > e for e in edges) == b for r in rows) for s in (False, True)]
        e, a = max(inside[0] / n[0], 1e-4), max(inside[1] / n[1], 1e-4)
        psi += (a - e) * math.log(a / e)
    assert quality.drift_psi(d).first()["psi"] == pytest.approx(psi, rel=1e-9)


def test_csv_columns_by_name(spark, tmp_path):
    s = files.STATIONS[:2]
    a, b = (tmp_path / files.STATION_FILE_PATTERN.format(station=x) for x in s)
    a.write_text("No,year,month,day,hour,PM2.5,PM10,SO2,NO2,CO,O3,TEMP,PRES,DEWP,RAIN,wd,WSPM,station\n"
                 f"1,2020,1,1,0,4,40,1,2,3,4,5,6,7,8,N,9,{s[0]}\n")
    b.write_text("No,year,month,day,hour,PM10,PM2.5,extra,SO2,station\n" f"1,2020,1,1,0,40,NA,x,1,{s[1]}\n")
    got = {r["station"]: r for r in files.read_readings(spark, str(tmp_path), s).collect()}
    assert got[s[0]]["pm25"] == 4.0 and got[s[0]]["pm10"] == 40.0 and got[s[0]]["wspm"] == 9.0
    assert got[s[1]]["pm25"] is None and got[s[1]]["pm10"] == 40.0 and got[s[1]]["o3"] is None
    aqi = tmp_path / "aqi.csv"
    aqi.write_text("Country,City,AQI Value,AQI Category,CO AQI Value,lat,lng\nX,Y,50,Good,77,1.5,2.5\n")
    r = files.read_global_aqi(spark, str(aqi)).first()
    assert (r["lat"], r["lng"], r["AQI Value"]) == (1.5, 2.5, "50")
    batch = tmp_path / "batch.csv"
    batch.write_text("id,PM10,TEMP\na,1.5,2\nb,3,4\n")
    rows = files.read_batch_csv(spark, str(batch), ["pm10", "temp"]).orderBy("row_index").collect()
    assert [(r["row_index"], r["id"], r["pm10"], r["temp"]) for r in rows] == [(0, "a", 1.5, 2.0), (1, "b", 3.0, 4.0)]
