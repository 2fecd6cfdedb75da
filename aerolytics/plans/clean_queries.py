"""Registered queries: cleaning, imputation, encoding, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolytics.operators import clean
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.sources.tables import readings, table, with_missing, with_sentinel, with_text_numbers

_MISSING_NEG = ("SELECT event_id, event_type AS station, ts AS datetime, "
                "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value - 20 END AS pm25 FROM events")


@register("impute_ffill_median", oracle=f"""
SELECT event_id, station, {R6('''CASE WHEN f < 0 THEN 0 ELSE f END''')} AS pm25 FROM (
  SELECT event_id, station,
    coalesce(last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY datetime
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             median(pm25) OVER (PARTITION BY station)) AS f
  FROM ({_MISSING_NEG}) r) t
""")
def q_impute_ffill_median(spark, sf_dir):
    """Nulls where id % 7 = 0 and negatives (value - 20): ffill, station median, clip."""
    r = readings(spark, sf_dir).withColumn("pm25", F.col("pm25") - 20)
    r = with_missing(r, "pm25")
    out = clean.impute_ffill_median(r, ["pm25"], key="station", time="datetime",
                                    clip_cols=["pm25"])
    return round_doubles(out.select("event_id", "station", "pm25"))


@register("clip_bounds", oracle=f"""
SELECT c_custkey,
  {R6('CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END')} AS low_clipped,
  {R6('CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 500 THEN 500 ELSE c_acctbal END')} AS both_clipped
FROM customer
""")
def q_clip_bounds(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    c = c.select("c_custkey", F.col("c_acctbal").alias("low_clipped"),
                 F.col("c_acctbal").alias("both_clipped"))
    c = clean.clip_columns(c, ["low_clipped"], lower=0.0)
    c = clean.clip_columns(c, ["both_clipped"], lower=0.0, upper=500.0)
    return round_doubles(c)


_SPARSE = ("SELECT event_id, value, CASE WHEN event_id % 3 <> 0 THEN value END AS most, "
           "CASE WHEN event_id % 3 = 0 THEN value END AS few, "
           "CAST(NULL AS DOUBLE) AS empty FROM events")


@register("drop_sparse_columns", oracle=f"SELECT event_id, {R6('value')} AS value, {R6('most')} AS most FROM ({_SPARSE}) t")
def q_drop_sparse_columns(spark, sf_dir):
    """A 66%-filled column survives; a 33%-filled and an all-null column are dropped."""
    ev = table(spark, sf_dir, "events")
    df = ev.select("event_id", "value",
                   F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("most"),
                   F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("few"),
                   F.lit(None).cast("double").alias("empty"))
    return round_doubles(clean.drop_sparse_columns(df, 0.5))


@register("sentinel_to_null", oracle=f"""
SELECT event_id, event_type, {R6('CASE WHEN v = -200 THEN NULL ELSE v END')} AS value
FROM (SELECT event_id, event_type, CASE WHEN event_id % 11 = 0 THEN -200 ELSE value END AS v FROM events) t
""")
def q_sentinel_to_null(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return round_doubles(clean.sentinel_to_null(with_sentinel(ev), exclude=("event_id",)))


@register("coerce_numeric", oracle=f"""
SELECT event_id, {R6('try_cast(t AS DOUBLE)')} AS value
FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS t FROM events) x
""")
def q_coerce_numeric(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return round_doubles(clean.coerce_numeric(with_text_numbers(ev), ["value"]))


@register("fill_constant", oracle=f"""
SELECT event_id, {R6('coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END, 0)')} AS value FROM events
""")
def q_fill_constant(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return round_doubles(clean.fill_constant(with_missing(ev, "value"), 0.0, ["value"]))


@register("drop_null_subset", oracle=f"""
SELECT event_id, {R6('v')} AS value
FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events) t
WHERE v IS NOT NULL
""")
def q_drop_null_subset(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return round_doubles(clean.drop_null_subset(with_missing(ev, "value"), ["value"]))


@register("impute_median", oracle=f"""
SELECT event_id, {R6('coalesce(v, median(v) OVER ())')} AS value
FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events) t
""")
def q_impute_median(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return round_doubles(clean.impute_median(with_missing(ev, "value"), ["value"]))


@register("assemble_timestamp", oracle="""
SELECT event_id, make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0.0) AS datetime FROM events
""")
def q_assemble_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"))
    return clean.assemble_timestamp(ev).select("event_id", "datetime")


@register("parse_timestamp", oracle="""
SELECT event_id, try_strptime(d || ' ' || t, '%d/%m/%Y %H.%M.%S') AS datetime FROM (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '31/02/2024' ELSE strftime(ts, '%d/%m/%Y') END AS d,
         strftime(ts, '%H.%M.%S') AS t FROM events) x
""")
def q_parse_timestamp(spark, sf_dir):
    """Text date + time (sensor-file format); an impossible date gives NULL for that row."""
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 13 == 0, F.lit("31/02/2024"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy")).alias("Date"),
        F.date_format("ts", "HH.mm.ss").alias("Time"))
    return clean.parse_timestamp(ev).select("event_id", "datetime")


@register("label_encode", oracle="""
SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
FROM orders
""")
def q_label_encode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return clean.label_encode(o, "o_orderpriority", "code").select("o_orderkey", "o_orderpriority", "code")


@register("label_encode_int", oracle="""
SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS code FROM orders
""")
def q_label_encode_int(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return clean.label_encode(o, "o_custkey", "code").select("o_orderkey", "o_custkey", "code")


@register("scale_standard", oracle=f"""
SELECT c_custkey, {R6('(c_acctbal - avg(c_acctbal) OVER ()) / CASE WHEN stddev_pop(c_acctbal) OVER () = 0 THEN 1 ELSE stddev_pop(c_acctbal) OVER () END')} AS scaled
FROM customer
""")
def q_scale_standard(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("scaled"))
    return round_doubles(clean.scale_standard(c, ["scaled"]))


@register("scale_minmax", oracle=f"""
SELECT c_custkey, {R6('CASE WHEN max(c_acctbal) OVER () = min(c_acctbal) OVER () THEN 0 ELSE (c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) END')} AS scaled
FROM customer
""")
def q_scale_minmax(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("scaled"))
    return round_doubles(clean.scale_minmax(c, ["scaled"]))


@register("pad_features", oracle=f"""
SELECT c_custkey, {R6('CAST(c_acctbal AS DOUBLE)')} AS c_acctbal, {R6('CAST(c_nationkey AS DOUBLE)')} AS c_nationkey,
  CAST(0.0 AS DOUBLE) AS c_rating
FROM customer
""")
def q_pad_features(spark, sf_dir):
    """Model order (acctbal, nationkey, rating); ``c_rating`` is absent and padded with 0."""
    c = table(spark, sf_dir, "customer")
    return round_doubles(clean.pad_features(c, ["c_acctbal", "c_nationkey", "c_rating"],
                                            keep=["c_custkey"]))
