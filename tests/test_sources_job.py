"""CSV sources (A1-A5), sinks (A6-A9) and the end-to-end training job (H21) on CSV files
generated from the driver's events table."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolytics.constants import STATION_FILE_PATTERN, STATIONS
from aerolytics.sources import files
from aerolytics.sources.tables import table
from tests.conftest import SF01

RAW_COLS = ["No", "year", "month", "day", "hour", "PM2.5", "PM10", "SO2", "NO2", "CO", "O3",
            "TEMP", "PRES", "DEWP", "RAIN", "wd", "WSPM", "station"]
WINDS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]


def _one_csv(df, folder, name, **opts):
    tmp = folder + "/_" + name
    df.coalesce(1).write.mode("overwrite").options(header=True, **opts).csv(tmp)
    part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
    os.replace(os.path.join(tmp, part), os.path.join(folder, name))


def make_station_csvs(spark, folder, sf_dir=SF01, n=3):
    ev = table(spark, sf_dir, "events")
    types = sorted(r[0] for r in ev.select("event_type").distinct().collect())[:n]
    for i, t in enumerate(types):
        h = (ev.filter(F.col("event_type") == t)
             .groupBy(F.date_trunc("hour", "ts").alias("t")).agg(F.avg("value").alias("v"))
             .withColumn("rn", F.row_number().over(Window.orderBy("t"))))  # small test fixture
        v = F.col("v")
        out = h.select(
            F.col("rn").alias("No"), F.year("t").alias("year"), F.month("t").alias("month"),
            F.dayofmonth("t").alias("day"), F.hour("t").alias("hour"),
            F.when(F.col("rn") % 9 == 0, F.lit("NA")).otherwise(v.cast("string")).alias("PM2.5"),
            (v * 1.3).alias("PM10"), (v / 10 - 2).alias("SO2"), (v / 3).alias("NO2"),
            (v * 10).alias("CO"), (80 - v / 5).alias("O3"), (F.hour("t") - 5.0).alias("TEMP"),
            (1010 + F.hour("t") / 10).alias("PRES"), (F.hour("t") - 10.0).alias("DEWP"),
            F.lit(0.0).alias("RAIN"),
            F.when(F.col("rn") % 17 == 0, F.lit("NA"))
             .otherwise(F.element_at(F.array(*[F.lit(w) for w in WINDS]), (F.col("rn") % 8 + 1).cast("int"))).alias("wd"),
            (F.col("rn") % 5 + 0.5).alias("WSPM"), F.lit(STATIONS[i]).alias("station"))
        _one_csv(out.select(*[F.col(f"`{c}`") for c in RAW_COLS]), folder, STATION_FILE_PATTERN.format(station=STATIONS[i]))
    return STATIONS[:n]


def test_read_readings_and_missing_files(spark, tmp_path):
    folder = str(tmp_path)
    names = make_station_csvs(spark, folder)
    df = files.read_readings(spark, folder)
    assert set(df.columns) >= {"pm25", "pm10", "wd", "station", "year"}
    assert {r[0] for r in df.select("station").distinct().collect()} == set(names)
    assert df.filter(F.col("pm25").isNull()).count() > 0  # "NA" became NULL
    with pytest.raises(FileNotFoundError):
        files.read_readings(spark, str(tmp_path / "nothing"))


def test_global_aqi_and_sensor_sources(spark, tmp_path):
    from aerolytics.operators import clean
    p = tmp_path / "aqi.csv"
    p.write_text("Country,City,AQI Value,AQI Category,lat,lng\n"
                 "A,X,55,Moderate,1.0,2.0\nB,Y,700,Smoky,0,0\nC,Z,bad,Good,3,4\nD,W,,Good,1,1\n")
    g = clean.clean_global_aqi(files.read_global_aqi(spark, str(p)))
    rows = {r["City"]: r for r in g.collect()}
    assert set(rows) == {"X", "Y", "Z"}
    assert rows["Y"]["AQI Value"] == 500.0 and rows["Y"]["AQI_Label"] == 1
    assert rows["Z"]["AQI Value"] is None and rows["X"]["AQI_Label"] == 1
    s = tmp_path / "sensor.csv"
    s.write_bytes(("Date;Time;CO(GT);T;Empty;;\n"
                   "10/03/2004;18.00.00;2,6;13,6;;;\n"
                   "10/03/2004;19.00.00;-200;13,3;;;\n"
                   "31/02/2004;20.00.00;2,2;-200;;;\n"
                   ";;;;;;\n").encode("latin-1"))
    u = clean.clean_sensor(files.read_sensor(spark, str(s)))
    got = sorted((r["CO(GT)"], r["T"]) for r in u.collect())
    assert "Empty" not in u.columns and "datetime" in u.columns
    want = sorted([(2.6, 13.6), (2.4, 13.3), (2.2, 13.45)])
    assert [pytest.approx(g) for g in got] == want


def test_batch_csv_and_row_index(spark, tmp_path):
    p = tmp_path / "batch.csv"
    p.write_text("PM10,SO2,other\n" + "".join(f"{i},{i * 2},x\n" for i in range(50)))
    df = files.read_batch_csv(spark, str(p), ["PM10", "SO2", "NO2"])
    got = sorted((r["row_index"], r["PM10"]) for r in df.collect())
    assert got == [(i, i) for i in range(50)]
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.read_batch_csv(spark, str(bad), ["PM10"])
    empty = tmp_path / "empty.csv"
    empty.write_text("PM10,SO2\n")
    with pytest.raises(Exception):
        files.read_batch_csv(spark, str(empty), ["PM10"])


def test_summary_round_trip(spark, tmp_path):
    from aerolytics.operators import evaluate
    runs = spark.createDataFrame([("time_series", "arima", 1, "rmse", 3.0),
                                  ("time_series", "additive", 2, "rmse", 2.0)],
                                 evaluate.MODEL_RUNS_SCHEMA)
    best = evaluate.best_model(runs, {"time_series": "rmse"})
    path = str(tmp_path / "s.json")
    s = files.write_summary(runs, best, path)
    assert json.load(open(path))["time_series"]["best_model"] == "additive"
    flat = files.flatten_summary(spark, s).collect()
    assert {r["task_title"] for r in flat} == {"Time Series"}
    assert files.flatten_summary(spark, {"x": {"all": {}}}).count() == 0
    assert files.read_projection_points(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception, match="(?i)parquet"):
        files.read_projection_points(spark, str(tmp_path / "broken")).count()


def test_training_job_end_to_end(spark, tmp_path):
    from aerolytics.plans import training_job
    src = str(tmp_path / "src")
    os.makedirs(src)
    make_station_csvs(spark, src, SF01, n=5)
    out = str(tmp_path / "out")
    summary = training_job.run(spark, src, out, small=True)
    assert set(summary) == {"classification", "regression", "time_series", "clustering", "projection"}
    assert {"silhouette", "calinski_harabasz"} <= set(summary["clustering"]["all"]["kmeans"])
    for t in summary.values():
        assert t["best_model"] and t["metrics"]
    assert spark.read.parquet(out + "/features").select("station").distinct().count() == 5
    assert spark.read.parquet(out + "/safety_profile").count() == 5 * 24
    assert os.path.exists(out + "/models/regressor") and os.path.exists(out + "/models/classifier")
    from aerolytics.operators import models, serving, stages
    one = serving.forecast_request(spark, out + "/forecast_state", 72, station=STATIONS[0]).collect()
    assert len(one) == 72 and all(0 <= r.lower <= r.prediction <= r.upper for r in one)
    assert serving.forecast_request(spark, out + "/forecast_state", 1).count() == 5
    with pytest.raises(ValueError):
        serving.forecast_request(spark, out + "/forecast_state", 0)
    # the saved pipeline scores a raw file, the saved clusterer and projection raw profiles and rows
    up = tmp_path / "upload.csv"
    up.write_text("datetime,wd,PM10,pm25_lag1\n2020-01-01 05:00:00,NE,50,40\n2020-01-01 06:00:00,,,\n")
    scored = models.score_csv(spark, str(up), out + "/models/regressor").orderBy("row_index").collect()
    assert [r.row_index for r in scored] == [0, 1] and all(r.pm25_prediction >= 0 for r in scored)
    feats = spark.read.parquet(out + "/features")
    model = models.load_model(out + "/models/classifier")
    coded = model.stages[1].transform(feats.select("wd", "wd_encoded").withColumnRenamed("wd_encoded", "before"))
    assert coded.where("before <> wd_encoded").count() == 0
    table = spark.read.parquet(out + "/station_clusters")
    cols = [c for c in table.columns if not c.startswith("cluster_")]
    again = stages.ProfileAssigner.load(out + "/models/clusterer").transform(table.select(*cols))
    assert again.join(table, "station").where("cluster <> cluster_kmeans").count() == 0
    points = stages.ProjectionStage.load(out + "/models/projection").transform(feats).where("pca_x is not null")
    assert points.count() == spark.read.parquet(out + "/projections").count()


def test_batch_rows_are_sorted_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """The number of files that are sorted grows with the table; the numbers stay those of the order."""
    from aerolytics.plans import artifact_queries
    rows = [(i * 37 % 500, float(i % 7), float(i % 3)) for i in range(2000)]
    spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(artifact_queries, "FILE_ROWS", 200, raising=False)
    folders = []
    plain = artifact_queries._folder
    monkeypatch.setattr(artifact_queries, "_folder", lambda s, name: folders.append(plain(s, name)) or folders[-1])
    got = artifact_queries.q_scan_batch_rows(spark, str(tmp_path))
    want = [(i, *r) for i, r in enumerate(sorted(rows))]
    assert sorted((r["row_index"], r["id"], r["pm10"], r["temp"]) for r in got.collect()) == want
    assert spark.read.text(folders[0]).select("_metadata.file_path").distinct().count() >= 8
