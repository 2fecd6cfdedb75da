"""The hot-key-safe (distributed) forms equal the single-task forms."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolytics.operators.keyed import group_positions, median_by_key, running_totals, POS
from aerolytics.sources.files import with_row_index
from aerolytics.sources.tables import readings, table
from tests.conftest import SF01


def test_median_distributed_equals_aggregate(spark):
    r = readings(spark, SF01).withColumn("pm25", F.round("pm25", 0))  # ties and duplicates
    a = {x.station: x.median for x in median_by_key(r, ["station"], "pm25", mode="aggregate").collect()}
    b = {x.station: x.median for x in median_by_key(r, ["station"], "pm25", mode="distributed").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == pytest.approx(a[k], abs=1e-12)
    g1 = median_by_key(r, [], "pm25", mode="aggregate").first()[0]
    g2 = median_by_key(r, [], "pm25", mode="distributed").first()[0]
    assert g1 == pytest.approx(g2, abs=1e-12)


def test_running_totals_bucketed_equals_plain(spark):
    ev = table(spark, SF01, "events")
    counts = ev.groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("c"))
    cols = ["event_type", "value", "cum_c", "tot_c"]
    p = sorted(map(tuple, running_totals(counts, ["event_type"], "value", ["c"], mode="plain").select(*cols).collect()))
    b = sorted(map(tuple, running_totals(counts, ["event_type"], "value", ["c"], mode="bucketed").select(*cols).collect()))
    assert p == b


def test_group_positions_equal_row_number(spark):
    ev = table(spark, SF01, "events").select("event_id", "event_type", "ts")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    want = {r.event_id: r.rn - 1 for r in ev.select("event_id", F.row_number().over(w).alias("rn")).collect()}
    got = group_positions(ev, ["event_type"], F.date_trunc("day", "ts"), [F.col("ts"), F.col("event_id")])
    assert {r.event_id: r[POS] for r in got.select("event_id", POS).collect()} == want


def test_row_index_exact(spark):
    df = spark.range(0, 5000, numPartitions=7).withColumnRenamed("id", "x")
    got = sorted((r.row_index, r.x) for r in with_row_index(df).collect())
    assert got == [(i, i) for i in range(5000)]


def test_impute_ffill_median_paths_agree(spark):
    from aerolytics.operators import clean
    from aerolytics.sources.tables import with_missing
    r = with_missing(readings(spark, SF01).withColumn("pm25", F.col("pm25") - 20), "pm25")
    a = clean.impute_ffill_median(r, ["pm25"], clip_cols=["pm25"], mode="plain")
    b = clean.impute_ffill_median(r, ["pm25"], clip_cols=["pm25"], mode="chunked", chunk_rows=97)
    ra = {x.event_id: x.pm25 for x in a.collect()}
    rb = {x.event_id: x.pm25 for x in b.collect()}
    assert ra.keys() == rb.keys() and len(ra) == 10000
    for k in ra:
        assert rb[k] == pytest.approx(ra[k], abs=1e-9)


def test_sized_cache_compacts_small_tables(spark):
    from aerolytics.operators.storage import sized_cache
    df = spark.range(0, 1000, numPartitions=50)
    small = sized_cache(df, rows_per_partition=400)
    assert small.rdd.getNumPartitions() == 3 and small.count() == 1000
    big = sized_cache(spark.range(0, 1000, numPartitions=2), rows_per_partition=100)
    assert big.rdd.getNumPartitions() == 2
    small.unpersist()
    big.unpersist()
