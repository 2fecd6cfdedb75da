"""Entity profiles (C1), hour-of-day safety score (C2) and top-n recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.constants import (ADVICE_MODERATE, ADVICE_SAFE, POLLUTANTS, SAFE_THRESHOLD,
                                  TOP_N_DEFAULT, TOP_N_MAX)
from aerolytics.functions.aqi import aqi_category, is_safe
from aerolytics.functions.calendar import hour_window_label


def station_profile(df: DataFrame, key: str = "station", measures=None) -> DataFrame:
    """Mean, sample std and max per measure per key: ``{m}_mean``, ``{m}_std``, ``{m}_max``.

    Measures missing from ``df`` are skipped. A partial + final hash aggregate: only one
    row per key and map task crosses the shuffle, whatever the skew.
    """
    measures = [m for m in (measures or POLLUTANTS) if m in df.columns]
    aggs = []
    for m in measures:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std"),
                 F.max(m).alias(f"{m}_max")]
    return df.groupBy(key).agg(*aggs)


def safety_score(df: DataFrame, key: str = "station", time: str = "datetime",
                 category: str = "aqi_category", pm25: str | None = None) -> DataFrame:
    """Share of safe readings per (key, hour of day).

    ``category`` is used when present; otherwise it is derived from ``pm25``.
    """
    cat = F.col(category) if category in df.columns else aqi_category(pm25 or "pm25")
    hour = F.col("hour") if "hour" in df.columns else F.hour(F.col(time))
    return (df.select(F.col(key), hour.alias("hour"), is_safe(cat).alias("_safe"))
            .groupBy(key, "hour").agg(F.avg("_safe").alias("safety_score")))


def recommend_windows(profile: DataFrame, top_n: int = TOP_N_DEFAULT, key: str = "station",
                      station: str | None = None) -> DataFrame:
    """Top-n safest hours per key: rank, hour, label, 3-decimal score, advice.

    Runs for all keys at once (``WindowGroupLimit`` keeps only n rows per key before the
    final sort). Ties on the score are broken by hour. ``station`` restricts to one key
    by case-insensitive match; an unknown key gives an empty result.
    """
    if not 1 <= top_n <= TOP_N_MAX:
        raise ValueError(f"top_n must be in 1..{TOP_N_MAX}")
    if station is not None:
        profile = profile.filter(F.lower(F.col(key).cast("string")) == F.lit(station.lower()))
    w = Window.partitionBy(key).orderBy(F.col("safety_score").desc(), F.col("hour").asc())
    return (profile.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top_n)
            .select(key, "rank", "hour",
                    hour_window_label("hour").alias("time_label"),
                    F.round("safety_score", 3).alias("safety_score"),
                    F.when(F.col("safety_score") >= SAFE_THRESHOLD, F.lit(ADVICE_SAFE))
                    .otherwise(F.lit(ADVICE_MODERATE)).alias("advice")))
