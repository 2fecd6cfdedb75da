"""Gaps of any length on hourly and weekly calendars."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolytics.operators import resample

FIRST = datetime(2020, 1, 1, 5)


def _readings(spark, hours):
    rows = [("a", FIRST + timedelta(hours=h), float(i + 1)) for i, h in enumerate(hours)]
    rows += [("b", FIRST, 7.0), (None, FIRST, 1.0), (None, FIRST + timedelta(hours=2), 3.0)]
    return spark.createDataFrame(rows, "station string, datetime timestamp_ntz, pm25 double")


@pytest.mark.parametrize("gap", [1, 2, resample.SLICE - 1, resample.SLICE, resample.SLICE + 1, 3 * resample.SLICE])
def test_hours_around_the_ends_of_slices(spark, gap):
    rows = resample.resample_hourly(_readings(spark, [0, gap, gap + 3])).collect()
    a = {r["datetime"]: r["pm25"] for r in rows if r["station"] == "a"}
    want = {FIRST + timedelta(hours=h): None for h in range(gap + 4)}
    want.update({FIRST: 1.0, FIRST + timedelta(hours=gap): 2.0, FIRST + timedelta(hours=gap + 3): 3.0})
    assert a == want and len(rows) == len(want) + 1 + 3
    assert [r["pm25"] for r in sorted((r for r in rows if r["station"] is None), key=lambda r: r["datetime"])] == [1.0, None, 3.0]


def test_reading_in_the_year_9000(spark):
    far = datetime(9000, 1, 1)
    hours = (far - FIRST) // timedelta(hours=1)
    got = resample.resample_hourly(_readings(spark, [0, hours])).where("station = 'a'").agg(
        F.count(F.lit(1)).alias("n"), F.count("pm25").alias("known"), F.sum("pm25").alias("s"),
        F.min("datetime").alias("lo"), F.max("datetime").alias("hi")).first()
    assert tuple(got) == (hours + 1, 2, 3.0, FIRST, far)
    weeks = resample.resample_weekly(_readings(spark, [0, hours])).where("station = 'a'").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mean").alias("s"), F.countDistinct("week_end").alias("d")).first()
    assert weeks["n"] == weeks["d"] == (far - datetime(2019, 12, 30)).days // 7 + 1 and weeks["s"] == 3.0
