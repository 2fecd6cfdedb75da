"""Lags of a stream: keys that share a group of the state (stream_lags)."""

from pyspark.sql import functions as F

from aerolytics.streaming.lags import lag_state_stream


def _batch(spark, rows, base, kind="string", **kw):
    """Append rows (id, key, hour, value) to the source and run over what has arrived."""
    (spark.createDataFrame(rows, "event_id long, station string, h double, pm25 double")
     .selectExpr("event_id", f"CAST(station AS {kind}) AS station",
                 "timestampadd(SECOND, CAST(h * 3600 AS INT), timestamp_ntz'2024-01-01') AS datetime", "pm25")
     .coalesce(1).write.mode("append").parquet(f"{base}/in"))
    schema = spark.read.parquet(f"{base}/in").schema
    out = lag_state_stream(spark.readStream.schema(schema).parquet(f"{base}/in"), lags=(1, 2), windows=(3,), **kw)
    (out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def _rows(spark, base):
    return {r["event_id"]: r for r in spark.read.parquet(f"{base}/out").collect()}


def test_state_calls_do_not_grow_with_keys(spark, tmp_path):
    """400 keys in 16 groups are 16 values of the state; before, one for each key."""
    rows = [(2 * k + i, str(k), float(i), float(k + i)) for k in range(400) for i in (0, 1)]
    base = str(tmp_path)
    _batch(spark, rows, base, "bigint", expire="3 hours", groups=16)
    got = _rows(spark, base)
    assert len(got) == 800 and all(got[2 * k + 1]["pm25_lag1"] == k and got[2 * k]["pm25_lag1"] is None
                                    and got[2 * k + 1]["station"] == k for k in range(400))
    kept = spark.read.format("statestore").option("stateVarName", "kept").load(f"{base}/state")
    assert 16 >= kept.where(F.col("value").isNotNull()).count() > 0


def test_keys_of_a_group_keep_their_own_history(spark, tmp_path):
    """One group for all: null and equal-looking keys, a late row, a row of an expired key, more
    rows than are held, and the same with a group for nearly each key."""
    first = [(1, "a", 0, 1.0), (2, "b", 0, 10.0), (3, None, 0, 100.0), (4, "a", 1, 2.0), (5, None, 1, None), (6, "A", 0, 5.0)]
    second = [(7, "a", 2, 3.0), (8, "b", 9, 20.0), (9, None, 2, 300.0), (10, "a", 0.5, 99.0), (11, "c", 9, 7.0), (12, "c", 9, 8.0)]
    third = [(13, "b", 10, 30.0), (14, "a", 11, 4.0), (15, "c", 10, 9.0)]
    outs = []
    for name, kw in (("one", {"groups": 1}), ("parked", {"groups": 1, "chunk_rows": 2}), ("many", {})):
        base = str(tmp_path / name)
        for part in (first, second, third):
            _batch(spark, [(i, k, float(h), v) for i, k, h, v in part], base, expire="3 hours", delay="1 hour", **kw)
        outs.append({i: (r["station"], r["pm25"], r["pm25_lag1"], r["pm25_lag2"], r["pm25_roll_mean3"], r["late_dropped"])
                     for i, r in _rows(spark, base).items()})
    assert outs[0] == outs[1] == outs[2]
    lag = {i: r[2:4] for i, r in outs[0].items()}
    assert lag[4] == (1.0, None) and lag[5] == (100.0, None) and lag[6] == (None, None)
    assert lag[7] == (2.0, 1.0) and lag[8] == (None, None) and lag[9] == (None, 100.0)
    assert lag[12] == (7.0, None) and lag[13] == (20.0, None) and lag[14] == (None, None) and lag[15] == (8.0, 7.0)
    assert outs[0][3][0] is None and 10 not in outs[0]


def test_key_types_come_back(spark, tmp_path):
    for kind in ("binary", "date", "int"):
        base = str(tmp_path / kind)
        key = {"binary": "éx", "date": "2024-02-29", "int": "7"}[kind]
        _batch(spark, [(1, key, 0.0, 1.0), (2, key, 1.0, 2.0), (3, None, 0.0, 3.0)], base, kind)
        out = spark.read.parquet(f"{base}/out")
        assert out.schema["station"].dataType.simpleString() == kind
        assert out.where(F.col("station") == F.lit(key).cast(kind)).count() == 2
        assert _rows(spark, base)[2]["pm25_lag1"] == 1.0


def test_rows_without_a_key_take_none_from_others(spark, tmp_path):
    """Null users are one key; every row of the numbered users stays."""
    rows = [(i, None if i % 9 == 0 else str(i * 7 % 40), float(i // 40), float(i)) for i in range(400)]
    base = str(tmp_path)
    _batch(spark, rows, base, "bigint", expire="18 hours")
    got, before = _rows(spark, base), {}
    assert len(got) == 400
    for i, key, _, v in rows:                            # rows come in the order of (time, id)
        assert got[i]["pm25_lag1"] == before.get(key) and got[i]["station"] == (None if key is None else int(key))
        before[key] = v
