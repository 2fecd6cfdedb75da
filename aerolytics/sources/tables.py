"""Parquet table access and the stand-in views the queries run on.

The station readings of the reference are not shipped, so the registered queries read the
driver tables: ``events`` is the readings table (station = ``event_type`` or ``user_id``,
datetime = ``ts``, pm25 = ``value``). Conditions such as missing values or sentinels are
injected by deterministic expressions that the DuckDB oracle repeats verbatim.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def readings(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    """Readings view: event_id, station, datetime, pm25 (column-pruned at the scan)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col(station).alias("station"),
                     F.col("ts").alias("datetime"), F.col("value").alias("pm25"))


# --- injected conditions (same expressions in the oracle SQL) -----------------------

def with_missing(df: DataFrame, col: str = "pm25", id_col: str = "event_id") -> DataFrame:
    """NULL where ``id % 7 = 0``."""
    return df.withColumn(col, F.when(F.col(id_col) % 7 == 0, F.lit(None).cast("double"))
                         .otherwise(F.col(col)))


def with_sentinel(df: DataFrame, col: str = "value", id_col: str = "event_id") -> DataFrame:
    """-200 where ``id % 11 = 0``."""
    return df.withColumn(col, F.when(F.col(id_col) % 11 == 0, F.lit(-200.0)).otherwise(F.col(col)))


def with_text_numbers(df: DataFrame, col: str = "value", id_col: str = "event_id") -> DataFrame:
    """Numbers as text, ``'bad'`` where ``id % 13 = 0``."""
    return df.withColumn(col, F.when(F.col(id_col) % 13 == 0, F.lit("bad"))
                         .otherwise(F.col(col).cast("string")))


def with_hourly_gaps(df: DataFrame, time: str = "datetime", value: str = "pm25") -> DataFrame:
    """NULL readings in the hours where ``hour % 5 = 0``."""
    return df.withColumn(value, F.when(F.hour(F.col(time)) % 5 != 0, F.col(value)))


def with_empty_weeks(df: DataFrame, time: str = "datetime", value: str = "pm25") -> DataFrame:
    """NULL readings from 2024-01-08 to before 2024-01-22."""
    t = F.col(time)
    return df.withColumn(value, F.when((t < F.lit("2024-01-08").cast("timestamp_ntz"))
                                       | (t >= F.lit("2024-01-22").cast("timestamp_ntz")), F.col(value)))
