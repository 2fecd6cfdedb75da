import os

import pytest
from pyspark.sql import functions as F

from aerolytics.operators import features as feat
from aerolytics.sources.tables import readings
from aerolytics.streaming.lags import lag_state_stream
from aerolytics.streaming.operators import read_stream, run_to_table
from tests.conftest import SF01


def test_stateful_lags_equal_batch_across_microbatches(spark, tmp_path):
    """Five time-ordered files streamed one per micro-batch; state carries the last
    values per station, so the result equals the batch window."""
    r = readings(spark, SF01, "event_type")
    src = str(tmp_path / "src")
    days = [("2024-01-01", "2024-01-07"), ("2024-01-07", "2024-01-13"), ("2024-01-13", "2024-01-19"),
            ("2024-01-19", "2024-01-25"), ("2024-01-25", "2024-02-01")]
    for i, (a, b) in enumerate(days):
        part = r.filter((F.col("datetime") >= F.lit(a).cast("timestamp_ntz"))
                        & (F.col("datetime") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
    # flatten into one folder with ordered file names
    flat = tmp_path / "flat"
    flat.mkdir()
    for i in range(len(days)):
        d = os.path.join(src, f"p{i}")
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), flat / f"{i:02d}.parquet")
    stream = read_stream(spark, str(flat), r.schema, max_files=1)
    base = str(tmp_path / "out")
    q = (lag_state_stream(stream).writeStream.format("parquet").outputMode("append")
         .option("path", base + "/o").option("checkpointLocation", base + "/c")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(base + "/o")
    want = feat.build_features(r, key="station", drop_warmup=False, calendar=False, label=False)
    cols = ["pm25_lag1", "pm25_lag24", "pm25_roll_mean3", "pm25_roll_std24"]
    g = {row.event_id: row for row in got.collect()}
    w = {row.event_id: row for row in want.collect()}
    assert len(g) == len(w) == 10000
    for eid, row in w.items():
        for c in cols:
            a, b = row[c], g[eid][c]
            if a is None:
                assert b is None or b != b  # NULL or NaN
            else:
                assert b == pytest.approx(a, rel=1e-9, abs=1e-9)
    assert got.agg(F.max("late_dropped")).first()[0] == 0


def test_stream_scoring_matches_batch(spark, tmp_path):
    """A fitted pipeline applied to a stream gives the batch predictions."""
    from aerolytics.operators import models
    r = readings(spark, SF01, "user_id")
    f = feat.build_features(r)
    inp, feats = models.model_input(f, ["pm25_lag1", "pm25_lag3", "hour_sin"], "pm25", keep=["event_id"])
    model = models.make_pipeline(feats, models.regressors("pm25", 0.0)[2][1]).fit(inp)
    src = str(tmp_path / "in")
    f.select("event_id", *feats).write.parquet(src)
    stream = read_stream(spark, src, spark.read.parquet(src).schema)
    from aerolytics.streaming.operators import score_stream
    out = run_to_table(spark, score_stream(stream, model, feats, keep=["event_id"]), "score")
    batch = models.score_regression(model, f, feats, keep=["event_id"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def _write(spark, rows, path):
    spark.createDataFrame(rows, "event_id long, station string, datetime timestamp_ntz, pm25 double") \
        .coalesce(1).write.parquet(path)


def test_late_rows_dropped_by_watermark_and_state(spark, tmp_path):
    import datetime as dt
    from aerolytics.streaming.operators import hourly_mean_stream
    t0 = dt.datetime(2024, 1, 1)
    h = lambda x: t0 + dt.timedelta(hours=x)
    src = tmp_path / "in"
    _write(spark, [(1, "a", h(0), 10.0), (2, "a", h(5), 20.0)], str(src / "b1"))
    _write(spark, [(3, "a", h(7), 30.0)], str(src / "b2"))
    # third batch: a row for hour 0 arrives after the watermark (7h - 1h) has passed it.
    # Spark filters late input against the previous batch's watermark, so the row is
    # dropped here (one batch earlier it could still have been aggregated).
    _write(spark, [(4, "a", h(0.5), 1000.0), (5, "a", h(8), 40.0)], str(src / "b3"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, d in enumerate(["b1", "b2", "b3"]):
        f = [x for x in os.listdir(src / d) if x.endswith(".parquet")][0]
        os.link(src / d / f, flat / f"{i:02d}.parquet")
    schema = spark.read.parquet(str(src / "b1")).schema
    out = run_to_table(spark, hourly_mean_stream(read_stream(spark, str(flat), schema, max_files=1),
                                                 delay="1 hour"), "late")
    got = {r.datetime: r.pm25 for r in out.collect()}
    assert got[h(0)] == 10.0  # the late 1000.0 did not change the closed hour
    state = run_to_table(spark, lag_state_stream(read_stream(spark, str(flat), schema, max_files=1),
                                                 lags=[1], windows=[3]), "late-state")
    rows = {r.event_id: r for r in state.collect()}
    assert 4 not in rows  # older than the newest time already in state: dropped
    assert rows[5].pm25_lag1 == 30.0 and rows[5].late_dropped == 1
    assert rows[3].pm25_lag1 == 20.0 and rows[3].pm25_roll_mean3 == 15.0


def test_lags_do_not_depend_on_batch_cuts(spark, tmp_path):
    """Rows that share a time are kept whichever micro-batch they come in."""
    from aerolytics.streaming import lags as so
    rows = [(1, "a", "2020-01-01 00:00:00", 1.0), (2, "a", "2020-01-01 01:00:00", 2.0),
            (3, "a", "2020-01-01 01:00:00", 3.0), (4, "a", "2020-01-01 02:00:00", 4.0)]
    schema = "event_id long, station string, s string, pm25 double"
    outs = []
    for name, cuts in (("one", [rows]), ("two", [rows[:2], rows[2:]])):
        src, out = tmp_path / name / "in", tmp_path / name / "out"
        for i, part in enumerate(cuts):
            (spark.createDataFrame(part, schema).withColumn("datetime", F.col("s").cast("timestamp_ntz")).drop("s")
             .coalesce(1).write.mode("append").parquet(str(src)))
            stream = spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))
            q = (so.lag_state_stream(stream, key="station", time="datetime", value="pm25", id_col="event_id",
                                     lags=(1,), windows=(3,))
                 .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / name / "ckpt"))
                 .trigger(availableNow=True).start(str(out)))
            q.awaitTermination(60)
        outs.append(sorted((r["event_id"], r["pm25_lag1"]) for r in spark.read.parquet(str(out)).collect()
                           if r["pm25_lag1"] == r["pm25_lag1"]))
    assert outs[0] == outs[1] and [i for i, _ in outs[0]][-3:] == [2, 3, 4]


def _stream_once(spark, base, **kw):
    src = spark.read.parquet(f"{base}/in")
    out = lag_state_stream(spark.readStream.schema(src.schema).parquet(f"{base}/in"), lags=(1, 2), windows=(3,), **kw)
    (out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def _hours(spark, rows, base):
    rows = [(i, s, float(h), v) for i, s, h, v in rows]
    (spark.createDataFrame(rows, "event_id long, station string, h double, pm25 double")
     .selectExpr("event_id", "station", "timestampadd(SECOND, CAST(h * 3600 AS INT), timestamp_ntz'2024-01-01') AS datetime", "pm25")
     .coalesce(1).write.mode("append").parquet(f"{base}/in"))


def test_expired_keys_start_anew(spark, tmp_path):
    """A silent key's state ends by its timer; a gap inside a micro-batch has the same effect, and
    a gap of exactly the limit has none."""
    base = str(tmp_path)
    _hours(spark, [(1, "a", 0, 1.0), (2, "a", 1, 2.0), (3, "b", 0, 5.0), (4, "c", 0, 7.0)], base)
    _stream_once(spark, base, expire="3 hours")
    _hours(spark, [(5, "b", 3, 6.0), (6, "c", 20, 8.0), (7, "c", 24, 9.0)], base)
    _stream_once(spark, base, expire="3 hours")
    _hours(spark, [(8, "a", 30, 3.0), (9, "a", 31, 4.0)], base)
    _stream_once(spark, base, expire="3 hours")
    got = {r["event_id"]: (r["pm25_lag1"], r["pm25_lag2"], r["pm25_roll_mean3"])
           for r in spark.read.parquet(f"{base}/out").collect()}
    new = (None, None, None)
    assert got == {1: new, 2: (1.0, None, 1.0), 3: new, 4: new, 5: (5.0, None, 5.0), 6: new, 7: new, 8: new,
                   9: (3.0, None, 3.0)}


def test_rows_beyond_memory_wait_in_state(spark, tmp_path):
    """Unsorted rows of one hot key, more than are held at once: bucket after bucket, same result."""
    import random
    rows = [(i, "hot", (i // 3) * 0.4, float(i * 37 % 101)) for i in range(400)]
    want = None
    for name, chunk in (("memory", 10_000), ("state", 50)):
        base = str(tmp_path / name)
        random.Random(1).shuffle(rows)
        _hours(spark, rows, base)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
        try:
            _stream_once(spark, base, chunk_rows=chunk)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got = sorted((tuple(r) for r in spark.read.parquet(f"{base}/out").collect()))
        assert len(got) == 400 and all(b[4] == a[3] for a, b in zip(got, got[1:]))
        want = want or got
        assert got == want


def test_scoring_survives_a_lost_commit(spark, tmp_path):
    """A micro-batch whose commit is lost runs again and replaces its own rows."""
    from aerolytics.operators import models
    from aerolytics.streaming.operators import epoch_sink, run_scoring
    train = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(50)], "x double, pm25 double")
    model = models.make_pipeline(["x"], models.regressors("pm25", 0.0)[2][1]).fit(train)
    base = str(tmp_path)
    models.save_model(model, f"{base}/model")
    calls = []
    inner = epoch_sink(f"{base}/model", ["x"], f"{base}/out", keep=["id"])

    def sink(batch, epoch):
        calls.append(epoch)
        inner(batch, epoch)

    for i in range(2):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "CAST(id AS DOUBLE) AS x").write.mode("append").parquet(f"{base}/in")
        run_scoring(read_stream(spark, f"{base}/in", "id long, x double"), sink, f"{base}/state")
    for f in os.listdir(f"{base}/state/commits"):
        if f.strip(".").startswith("1"):
            os.remove(f"{base}/state/commits/{f}")
    run_scoring(read_stream(spark, f"{base}/in", "id long, x double"), sink, f"{base}/state")
    assert calls == [0, 1, 1]
    out = {r["id"]: r["pm25_prediction"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert spark.read.parquet(f"{base}/out").count() == 20 and all(abs(v - (2 * i + 1)) < 0.01 for i, v in out.items())
    with pytest.raises(Exception):
        run_scoring(read_stream(spark, f"{base}/in", "id long, x double"),
                    epoch_sink(f"{base}/none", ["x"], f"{base}/o2"), f"{base}/s2")
