import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolytics.operators import features as feat
from aerolytics.sources.tables import readings
from tests.conftest import SF01


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _frame(spark, values, key="a"):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(key, base + dt.timedelta(hours=i), v) for i, v in enumerate(values)],
        "station string, datetime timestamp_ntz, pm25 double")


def test_rolling_hand_frame(spark):
    out = feat.add_rolling_features(_frame(spark, [1.0, 5.0, None, 7.0]), "pm25", [3])
    got = [(r.pm25_roll_mean3, r.pm25_roll_std3) for r in out.orderBy("datetime").collect()]
    assert got[0] == (None, 0.0)
    assert got[1] == (1.0, 0.0)
    assert got[2][0] == 3.0 and got[2][1] == pytest.approx(2.828427, abs=1e-6)
    assert got[3][0] == 3.0 and got[3][1] == pytest.approx(2.828427, abs=1e-6)


def test_lag_row_based(spark):
    out = feat.add_lag_features(_frame(spark, [1.0, 2.0, 3.0]), "pm25", [1, 2])
    got = [(r.pm25_lag1, r.pm25_lag2) for r in out.orderBy("datetime").collect()]
    assert got == [(None, None), (1.0, None), (2.0, 1.0)]


@pytest.mark.parametrize("key", ["station", None])
def test_chunked_equals_plain(spark, key):
    """The hot-key (chunked) plan gives exactly the plain window's result."""
    r = readings(spark, SF01, "event_type")
    cols = ["event_id", "pm25_lag1", "pm25_lag24", "pm25_roll_mean3", "pm25_roll_std24"]
    plain = feat.build_features(r, key=key, mode="plain", drop_warmup=False)
    chunked = feat.build_features(r, key=key, mode="chunked", chunk_rows=50, drop_warmup=False)
    a, b = _rows(plain, cols), _rows(chunked, cols)
    assert len(a) == len(b) == 10000
    for x, y in zip(a, b):
        assert x[0] == y[0]
        for u, v in zip(x[1:], y[1:]):
            assert (u is None and v is None) or u == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_forward_fill_chunked(spark):
    r = readings(spark, SF01, "event_type").withColumn(
        "pm25", F.when((F.col("event_id") % 7 == 0) | (F.col("event_id") % 5 == 0), None)
        .otherwise(F.col("pm25")))
    plain = feat.forward_fill(r, "pm25", mode="plain")
    chunked = feat.forward_fill(r, "pm25", mode="chunked", chunk_rows=7)
    assert _rows(plain, ["event_id", "pm25"]) == _rows(chunked, ["event_id", "pm25"])


def test_label_edges(spark):
    vals = [12.0, 12.01, 35.4, 55.4, 150.4, 250.4, 250.41, None]
    df = spark.createDataFrame([(v,) for v in vals], "pm25 double")
    got = [r.aqi_label for r in feat.add_aqi_label(df).collect()]
    assert got == [0, 1, 1, 2, 3, 4, 5, 5]


def test_chunked_equals_plain_when_one_day_holds_everything(spark):
    """Time buckets are per-key quantiles: rows squeezed into one day still split."""
    r = readings(spark, SF01, "event_type").withColumn(
        "datetime", F.timestamp_add("SECOND", F.col("event_id"), F.lit("2024-01-01").cast("timestamp_ntz")))
    cols = ["event_id", "pm25_lag1", "pm25_lag24", "pm25_roll_mean6", "pm25_roll_std3"]
    plain = feat.build_features(r, mode="plain", drop_warmup=False)
    chunked = feat.build_features(r, mode="chunked", chunk_rows=64, drop_warmup=False)
    a, b = _rows(plain, cols), _rows(chunked, cols)
    assert len(a) == len(b) == 10000
    for x, y in zip(a, b):
        assert x[0] == y[0]
        for u, v in zip(x[1:], y[1:]):
            assert (u is None and v is None) or u == pytest.approx(v, rel=1e-9, abs=1e-9)
