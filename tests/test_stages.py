"""Saved pipelines: stages keep what training learned, also in another process."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from aerolytics.operators import models, stages
from aerolytics.sources import files
from tests.conftest import ROOT

ROWS = [(1, "2024-01-01 05:00:00", "NE", 4.0), (2, "2024-06-03 17:00:00", None, 6.0),
        (3, "2024-02-01 00:00:00", "SW", 9.0), (4, "bad", "E", None), (5, None, "NE", 1.0)]


def _frame(spark):
    return spark.createDataFrame(ROWS, "id long, datetime string, wd string, pm25 double")


def test_codes_and_calendar_equal_training(spark):
    from aerolytics.operators.clean import label_encode
    from aerolytics.operators.features import add_calendar_features
    df = _frame(spark)
    coder = stages.TextCoder(inputCol="wd", outputCol="code", nullAs="N").fit(df)
    assert coder.getOrDefault(coder.values) == ["E", "N", "NE", "SW"]
    got = {r["id"]: r["code"] for r in coder.transform(df).collect()}
    assert got == {r["id"]: r["wd_encoded"] for r in label_encode(df, "wd", "wd_encoded", null_as="N").collect()}
    new = spark.createDataFrame([(1, "Q"), (2, None)], "id long, wd string")
    assert {r["code"] for r in coder.transform(new).collect()} == {1}                    # unknown: as NULL
    plain = stages.TextCoder(inputCol="wd", outputCol="code").fit(df)
    assert {r["code"] for r in plain.transform(new).collect()} == {None}
    assert coder.transform(df.drop("wd")).columns == ["id", "datetime", "pm25"]
    cal = stages.CalendarStage(timeCol="datetime").transform(df.withColumn("hour", F.lit(99)))
    want = {r["id"]: r for r in add_calendar_features(df.withColumn("t", F.col("datetime").try_cast("timestamp_ntz")), "t").collect()}
    for r in cal.collect():
        assert r["hour"] == 99 and r["hour_sin"] == want[r["id"]]["hour_sin"] and r["month"] == want[r["id"]]["month"]


def test_padding_defaults(spark):
    out = stages.PadStage(features=["b", "hour_cos", "a"]).transform(
        spark.createDataFrame([("x", "1.5"), ("y", "bad"), ("z", None)], "id string, a string")).orderBy("id").collect()
    assert [(r["b"], r["hour_cos"], r["a"]) for r in out] == [(0.0, 1.0, 1.5), (0.0, 1.0, 0.0), (0.0, 1.0, 0.0)]


def test_classification_scoring_counts_absent_cosines_as_one(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 2), i % 2) for i in range(40)], "hour_cos double, x double, y int")
    est = models.classifiers("y", rf_trees=3, rf_depth=2)[0][1]
    model = models.make_pipeline(["hour_cos"], est).fit(df)
    batch = spark.createDataFrame([(7,)], "id long")
    assert models.score_classification(model, batch, ["hour_cos"], keep=["id"]).first()["aqi_label"] == 1


def test_a_pipeline_loaded_by_another_process_scores_the_same(spark, tmp_path):
    df = _frame(spark).where("pm25 IS NOT NULL")
    raw = [stages.CalendarStage(timeCol="datetime"), stages.TextCoder(inputCol="wd", outputCol="wd_encoded", nullAs="N").fit(df)]
    features = ["hour_cos", "wd_encoded", "absent"]
    train = df
    for s in [*raw, stages.PadStage(features=features)]:
        train = s.transform(train)
    fitted = models.make_pipeline(features, models.regressors("pm25", 0.1)[2][1]).fit(train)
    model, csv = str(tmp_path / "model"), str(tmp_path / "in.csv")
    models.save_model(models.full_pipeline(fitted, features, *raw), model)
    with open(csv, "w") as f:
        f.write("id,wd,datetime\n" + "".join(f"{i},{w or ''},{t or ''}\n" for i, t, w, _ in ROWS))
    here = [tuple(r) for r in models.score_csv(spark, csv, model).orderBy("row_index").collect()]
    assert len(here) == 5 and len({p for _, p, _ in here}) > 2
    code = (f"import sys, json; sys.path.insert(0, {ROOT!r}); from aerolytics.session import get_session; "
            "from aerolytics.operators import models; s = get_session('local[2]', 2); "
            f"print('ROWS' + json.dumps([tuple(r) for r in models.score_csv(s, {csv!r}, {model!r}).orderBy('row_index').collect()]))")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180,
                         env={**os.environ, "AEROLYTICS_DRIVER_MEMORY": "1g"})
    out = [x for x in run.stdout.splitlines() if x.startswith("ROWS")]
    assert out and [tuple(r) for r in json.loads(out[0][4:])] == here, run.stderr[-2000:]
    assert models.load_model(str(tmp_path / "none")) is None
    os.makedirs(tmp_path / "broken")
    with pytest.raises(Exception):
        models.load_model(str(tmp_path / "broken"))


def test_row_index_over_files_and_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    n = 0
    for name, rows in (("a", 700), ("b", 1), ("c", 2000), ("d", 0)):
        (folder / f"{name}.csv").write_text("x,PM10\n" + "".join(f"{n + i},{i}\n" for i in range(rows)))
        n += rows
    size = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "1k")
    try:
        df = files.read_batch_csv(spark, str(folder), ["pm10"])
    finally:
        spark.conf.set(size, old)
    got = [(r["row_index"], int(r["x"])) for r in df.collect()]
    assert sorted(got) == [(i, i) for i in range(n)]
