"""Map-point projection (B20, B21) and map totals (C14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.constants import AQI_CATEGORIES, UNKNOWN_TEXT


def map_points(df: DataFrame, city="City", country="Country", lat="lat", lng="lng",
               aqi="AQI Value", category="AQI Category", text_null: str = UNKNOWN_TEXT,
               mappable_only: bool = True) -> DataFrame:
    """Six point columns (numeric NULL -> 0, text NULL -> ``text_null``) plus marker radius
    ``clamp(aqi / 10, 4, 15)``; rows with lat or lng NULL/0 are not mappable."""
    def num(c):
        return F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))

    def txt(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(text_null))

    pts = df.select(txt(city).alias("city"), txt(country).alias("country"),
                    num(lat).alias("lat"), num(lng).alias("lng"),
                    num(aqi).alias("aqi_value"), txt(category).alias("aqi_category"))
    pts = pts.withColumn("radius", F.least(F.greatest(F.col("aqi_value") / 10, F.lit(4.0)),
                                           F.lit(15.0)))
    if mappable_only:
        pts = pts.filter((F.col("lat") != 0) & (F.col("lng") != 0))
    return pts


def map_summary(points: DataFrame) -> DataFrame:
    """All points, mappable points, and Hazardous points among the mappable ones."""
    mappable = (F.col("lat") != 0) & (F.col("lng") != 0)
    return points.agg(
        F.count(F.lit(1)).alias("total_points"),
        F.count_if(mappable).alias("mappable_points"),
        F.count_if(mappable & (F.col("aqi_category") == F.lit(AQI_CATEGORIES[-1])))
        .alias("hazardous_points"))
