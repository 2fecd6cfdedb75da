"""Calendar regularisation (C3, C4, D5): hourly / weekly means on complete calendars and
linear interpolation of gaps, for all keys in one job.

The mean is a partial + final hash aggregate on (key, period). Gaps are filled from
``lead()``: every period also emits the empty ones before the next, so the input is read
and aggregated once and no calendar is joined or held per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.functions.calendar import trunc_ntz, week_ending_sunday
from aerolytics.functions.scalar import clip

#: steps of a gap that are held as one array
SLICE = 4096


def resample_hourly(df: DataFrame, key: str = "station", time: str = "datetime",
                    value: str = "pm25", station: str | None = None) -> DataFrame:
    """Hourly mean on a complete hourly calendar from each key's first to last hour.

    Hours without readings get NULL (``resample('h').mean()``); NULL readings are dropped
    first, as in the reference. ``station`` filters one key (pushed to the scan).
    """
    if station is not None:
        df = df.filter(F.col(key) == F.lit(station))
    hourly = (df.filter(F.col(value).isNotNull())
              .groupBy(key, trunc_ntz("hour", time).alias(time))
              .agg(F.avg(value).alias(value)))
    return _fill_gaps(hourly, key, time, value, 1, "HOUR")


def _fill_gaps(df: DataFrame, key: str, time: str, value: str, steps: int, unit: str) -> DataFrame:
    """Rows on a regular grid per key plus a NULL row for each step missing in between.

    A gap is cut into slices of ``SLICE`` steps, which are spelled out one after the other, so
    a gap of any length (one far-out timestamp is millions of hours) holds one short array at
    a time and the long rows of its slices carry two timestamps only.
    """
    step, slice_step = F.expr(f"INTERVAL {steps} {unit}"), F.expr(f"INTERVAL {steps * SLICE} {unit}")
    last = F.expr(f"INTERVAL {steps * (SLICE - 1)} {unit}")
    following = F.lead(time).over(Window.partitionBy(key).orderBy(time))
    d = df.withColumn("_until", F.coalesce(following - step, F.col(time)))
    d = d.select(key, time, value, "_until", F.explode(F.sequence(F.col(time), F.col("_until"), slice_step)).alias("_from"))
    to = F.least(F.col("_from") + last, F.col("_until"))
    d = d.select(key, time, value, F.explode(F.sequence(F.col("_from"), to, step)).alias("_t"))
    return d.select(key, F.col("_t").alias(time), F.when(F.col("_t") == F.col(time), F.col(value)).alias(value))


def interpolate_linear(df: DataFrame, key: str = "station", time: str = "datetime",
                       value: str = "pm25") -> DataFrame:
    """Linear interpolation in time between the previous and next non-null values.

    Leading gaps stay NULL, trailing gaps repeat the last value (pandas ``interpolate``
    on a regular grid).
    """
    w = Window.partitionBy(key).orderBy(time)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the next known value is the last one met from the other end: a growing frame, linear
    # in the rows of a key
    ahead = Window.partitionBy(key).orderBy(F.col(time).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    known_t = F.when(F.col(value).isNotNull(), F.col(time))
    pv = F.last(F.col(value), ignorenulls=True).over(back)
    pt = F.last(known_t, ignorenulls=True).over(back)
    nv = F.last(F.col(value), ignorenulls=True).over(ahead)
    nt = F.last(known_t, ignorenulls=True).over(ahead)
    step = df.select("*", pv.alias("_pv"), pt.alias("_pt"), nv.alias("_nv"), nt.alias("_nt"))
    frac = (F.timestamp_diff("SECOND", F.col("_pt"), F.col(time)).cast("double")
            / F.timestamp_diff("SECOND", F.col("_pt"), F.col("_nt")).cast("double"))
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col("_pv").isNull(), F.lit(None).cast("double"))
              .when(F.col("_nv").isNull(), F.col("_pv"))
              .otherwise(F.col("_pv") + (F.col("_nv") - F.col("_pv")) * frac))
    return step.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])


def prepare_series(df: DataFrame, key: str = "station", time: str = "datetime",
                   value: str = "pm25", station: str | None = None) -> DataFrame:
    """Regular hourly series per key: hourly mean + linear interpolation (C3 + D5)."""
    return interpolate_linear(resample_hourly(df, key, time, value, station), key, time, value)


def resample_weekly(df: DataFrame, key: str = "station", time: str = "datetime",
                    value: str = "pm25", places: int = 2) -> DataFrame:
    """Weekly mean of the value clipped at 0; weeks run Monday..Sunday and are labelled by
    their Sunday (``YYYY-MM-DD``); empty weeks inside each key's range give 0."""
    wk = (df.select(key, week_ending_sunday(time).alias("_week"),
                    clip(value, 0.0).alias("_v"))
          .groupBy(key, "_week").agg(F.avg("_v").alias("_mean")))
    return (_fill_gaps(wk, key, "_week", "_mean", 7, "DAYS")
            .select(key, F.date_format("_week", "yyyy-MM-dd").alias("week_end"),
                    F.round(F.coalesce(F.col("_mean"), F.lit(0.0)), places).alias("mean")))


def station_weekly_series(df: DataFrame, station: str, allowed, key: str = "station",
                          time: str = "datetime", value: str = "pm25") -> DataFrame:
    """Weekly series of one requested station (§3.3). The name must be on the allow-list
    (a path-like or unknown name is rejected before any data is read); the filter on the
    key reaches the scan, or prunes partitions when the table is stored by station."""
    if station not in set(allowed):
        raise ValueError(f"unknown station {station!r}")
    return resample_weekly(df.filter(F.col(key) == F.lit(station)), key, time, value)
