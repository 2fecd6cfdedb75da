"""File sources and sinks.

CSV families are read with explicit schemas (no inference pass), ``NA`` as NULL, and one
``spark.read`` call over all existing paths (a single scan, not a loop of unions).
Inside the engine, column names are lower case (``PM2.5`` -> ``pm25``).
"""

from __future__ import annotations

import json
import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolytics.constants import RAW_POLLUTANTS, RAW_WEATHER, STATION_FILE_PATTERN, STATIONS
from aerolytics.functions.scalar import decimal_comma_double
from aerolytics.operators.storage import stored

log = logging.getLogger(__name__)

READINGS_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("No", "year", "month", "day", "hour")]
    + [T.StructField(c, T.DoubleType()) for c in RAW_POLLUTANTS + RAW_WEATHER[:4]]
    + [T.StructField("wd", T.StringType()), T.StructField("WSPM", T.DoubleType()),
       T.StructField("station", T.StringType())])

GLOBAL_AQI_SCHEMA = T.StructType([
    T.StructField("Country", T.StringType()), T.StructField("City", T.StringType()),
    T.StructField("AQI Value", T.StringType()), T.StructField("AQI Category", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])


def internal_name(raw: str) -> str:
    """``PM2.5`` -> ``pm25``, ``TEMP`` -> ``temp``."""
    return raw.replace(".", "").lower()


def to_internal(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or RAW_POLLUTANTS + RAW_WEATHER
    return df.select(*[F.col(f"`{c}`").alias(internal_name(c)) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def exists(path: str) -> bool:
    """Through the file system of the path (HDFS, object store, local)."""
    spark = SparkSession.getActiveSession()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def station_paths(root: str, stations=STATIONS) -> list[str]:
    """Existing station files; a missing file is skipped with a warning, none is an error."""
    paths = []
    for s in stations:
        p = os.path.join(root, STATION_FILE_PATTERN.format(station=s))
        if exists(p):
            paths.append(p)
        else:
            log.warning("station file not found: %s", p)
    if not paths:
        raise FileNotFoundError(f"no station files under {root}")
    return paths


def read_by_name(spark: SparkSession, paths, schema: T.StructType, **options: str) -> DataFrame:
    """CSV files with a header, columns found by name whatever their order.

    The header of every file is read first (one line each); files with one header share a
    scan. Columns of ``schema`` that a file lacks are NULL, others are not read, and values
    are cast after reading (unparsable: NULL).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    by_header: dict[tuple, list[str]] = {}
    for p in paths:
        header = tuple(spark.read.option("header", True).options(**options).csv(p).columns)
        by_header.setdefault(header, []).append(p)
    parts = []
    for header, same in sorted(by_header.items(), key=lambda x: x[1][0]):
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        raw = spark.read.schema(text).option("header", True).option("enforceSchema", True).options(**options).csv(same)
        parts.append(raw.select(*[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in header else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema]))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionAll(x)
    return out


def read_readings(spark: SparkSession, root: str, stations=STATIONS) -> DataFrame:
    """A1: all station CSVs in one scan per header, union by name through the fixed schema."""
    return to_internal(read_by_name(spark, station_paths(root, stations), READINGS_SCHEMA, nullValue="NA"))


def read_global_aqi(spark: SparkSession, path: str) -> DataFrame:
    """A2: country-level AQI CSV, by column name (values kept as text until coerced by the
    cleaner); further columns are not read."""
    return read_by_name(spark, path, GLOBAL_AQI_SCHEMA)


def read_sensor(spark: SparkSession, path: str) -> DataFrame:
    """A3: ``;``-separated, decimal comma, latin-1. Text columns are parsed per value;
    all-empty trailing columns are dropped by the cleaner (B6)."""
    raw = (spark.read.option("header", True).option("sep", ";")
           .option("encoding", "ISO-8859-1").option("inferSchema", False).csv(path))
    keep = [c for c in raw.columns if not c.startswith("_c")]
    return raw.select(*[F.col(f"`{c}`") if c in ("Date", "Time")
                        else decimal_comma_double(F.col(f"`{c}`")).alias(c) for c in keep])


def load_all(spark: SparkSession, root: str, aqi_file: str = "AQI and Lat Long of Countries.csv",
             sensor_file: str = "AirQualityUCI.csv") -> dict[str, DataFrame]:
    """A4: the named set of source tables (missing optional families are left out)."""
    out = {"readings": read_readings(spark, root)}
    for name, fname, fn in (("global_aqi", aqi_file, read_global_aqi),
                            ("sensor", sensor_file, read_sensor)):
        p = os.path.join(root, fname)
        if exists(p):
            out[name] = fn(spark, p)
    return out


def read_batch_csv(spark: SparkSession, path, known_features, known_text=()) -> DataFrame:
    """A5: ad-hoc batch CSV (one or several files of one header); unparsable or empty input is
    an error, and at least one known column is required, by its name or by the raw one
    (``PM2.5`` for ``pm25``). Row index 0..n-1 follows the order of the files and their rows."""
    known, text_cols = set(known_features), set(known_text)
    header = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(path)
    names = {c: c if c in known | text_cols else internal_name(c) for c in header}
    if not (known | text_cols) & set(names.values()):
        raise ValueError("batch has none of the model's feature columns")
    # features are doubles (a value that is none fails the batch), other columns stay text
    df = raw.select(*[F.col(f"`{c}`").cast("double").alias(names[c]) if names[c] in known
                      else F.col(f"`{c}`").alias(names[c] if names[c] in text_cols else c) for c in header])
    if df.limit(1).count() == 0:
        raise ValueError("batch is empty")
    return with_row_index(df)


def with_row_index(df: DataFrame, out: str = "row_index") -> DataFrame:
    """Exact 0..n-1 index in the order of the files and their rows (F11), however the files are
    split over tasks; a table that is not read from files is numbered in partition order.

    The rows are written once with their split (file and first byte) and a number that grows
    inside the split, so nothing is evaluated twice. A split's offset is the count of earlier
    files plus that of the file's earlier splits; no task orders more than the files, or the
    splits of one file.
    """
    number = F.monotonically_increasing_id().alias("__number")
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("__file"),
                           F.col("_metadata.file_block_start").alias("__block"), number)
    except AnalysisException:                            # no files behind this plan
        placed = df.select("*", F.lit("").alias("__file"), F.spark_partition_id().cast("long").alias("__block"), number)
    held = stored(placed, "row-index")
    splits = held.groupBy("__file", "__block").agg(F.min("__number").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(Window.partitionBy("__file").orderBy("__block")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = splits.groupBy("__file").agg(F.sum("__n").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = splits.withColumn("__in", earlier).drop("__n") \
        .join(whole.select("__file", before.alias("__before")), "__file")
    index = (F.col("__before") + F.col("__in") + F.col("__number") - F.col("__first")).alias(out)
    return held.join(offsets, ["__file", "__block"]).select(*[F.col(f"`{c}`") for c in df.columns], index)


def read_projection_points(spark: SparkSession, path: str) -> DataFrame:
    """Read back a projection table; missing -> empty; numbers NULL -> 0, text -> Unknown."""
    schema = "pca_x double, pca_y double, station string, aqi_category string"
    if not exists(path):                                 # no projection yet; an unreadable one is an error
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path)
    nums = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint")]
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in nums
                       else F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(c)
                       for c in df.columns])


def write_table(df: DataFrame, path: str, partition_by=None) -> None:
    """Overwrite a table sink (re-runnable), optionally partitioned (e.g. by station)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file through the file system of its path (HDFS, object store, local)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def write_summary(runs: DataFrame, best: DataFrame, path: str) -> dict:
    """Nested summary per task {best_model, metrics, all} from the (small) model_runs
    table; also returned as a dict."""
    summary: dict = {}
    best_rows = {r["task"]: r["model"] for r in best.collect()}
    for r in runs.orderBy("task", "trained_order", "metric").collect():
        t = summary.setdefault(r["task"], {"best_model": best_rows.get(r["task"]),
                                           "metrics": {}, "all": {}})
        t["all"].setdefault(r["model"], {})[r["metric"]] = r["value"]
        if r["model"] == t["best_model"]:
            t["metrics"][r["metric"]] = r["value"]
    if path:
        write_text(runs.sparkSession, path, json.dumps(summary, indent=2))
    return summary


def flatten_summary(spark: SparkSession, summary: dict) -> DataFrame:
    """Nested summary -> rows (task title, model, metric, value, is_best); tasks without
    metrics give no rows."""
    rows = []
    for task, body in summary.items():
        title = task.replace("_", " ").title()
        for model, metrics in (body.get("all") or {}).items():
            for metric, value in (metrics or {}).items():
                rows.append((title, model, metric, float(value), model == body.get("best_model")))
    return spark.createDataFrame(rows, "task_title string, model string, metric string, value double, is_best boolean")
