"""Cleaning operators (B1-B12, B18, C5-C9, D1) as lazy DataFrame transforms.

Statistics needed by an operator (counts, medians, means, min/max) are computed by one
aggregate. A global aggregate is a single row, used through scalar subqueries (computed
once, inlined as values); per-key statistics are joined on the key and AQE turns the join
into a broadcast only when the runtime size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolytics.constants import NUMERIC, POLLUTANTS, SENSOR_SENTINEL, UCI_TIME_FORMAT
from aerolytics.functions.aqi import category_to_code
from aerolytics.functions.scalar import clip, coerce_double, one_row
from aerolytics.operators.features import forward_fill
from aerolytics.operators.joins import null_safe_join
from aerolytics.operators.keyed import (POS, group_positions, keyed_frame, max_distinct_many,
                                       median_by_key)
from aerolytics.operators.storage import stored

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --- B1, B2: time assembly and parsing ----------------------------------------------

def assemble_timestamp(df: DataFrame, year="year", month="month", day="day", hour="hour",
                       out: str = "datetime") -> DataFrame:
    """``make_timestamp_ntz`` from date parts; an invalid date raises under ANSI mode."""
    ts = F.make_timestamp_ntz(F.col(year), F.col(month), F.col(day), F.col(hour),
                              F.lit(0), F.lit(0))
    return df.withColumn(out, ts)


def parse_timestamp(df: DataFrame, date_col="Date", time_col="Time",
                    fmt: str = UCI_TIME_FORMAT, out: str = "datetime") -> DataFrame:
    """``Date + ' ' + Time`` parsed per row; unparsable rows become NULL (not the column)."""
    text = F.concat_ws(" ", F.col(date_col), F.col(time_col))
    return df.withColumn(out, F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"))


# --- B3-B8: drops and fills ---------------------------------------------------------

def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop columns, ignoring the absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_null_subset(df: DataFrame, subset) -> DataFrame:
    return df.na.drop(how="any", subset=[c for c in subset if c in df.columns])


def column_fill_counts(df: DataFrame) -> dict[str, int]:
    """Non-null count of every column and the row count, in one aggregate pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(_q(c))).alias(c) for c in df.columns]).first()
    return row.asDict()


def drop_sparse_columns(df: DataFrame, min_fraction: float | None = 0.5,
                        drop_all_null: bool = True) -> DataFrame:
    """Drop all-null columns (B6) and columns with fewer than ``int(n * min_fraction)``
    non-nulls (B7). One count pass; the column choice is a driver-side ``select``."""
    counts = column_fill_counts(df)
    n = counts.pop("__n")
    keep = []
    for c in df.columns:
        nn = counts[c]
        if drop_all_null and nn == 0:
            continue
        if min_fraction is not None and nn < int(n * min_fraction):
            continue
        keep.append(c)
    return df.select(*[F.col(_q(c)) for c in keep])


def fill_constant(df: DataFrame, value, cols=None) -> DataFrame:
    cols = list(cols) if cols is not None else None
    return df.na.fill(value, subset=cols) if cols else df.na.fill(value)


# --- B9-B12: clip, coerce, sentinel, tolerant projection -----------------------------

def clip_columns(df: DataFrame, cols, lower=None, upper=None) -> DataFrame:
    cols = [c for c in cols if c in df.columns]
    return df.select(*[clip(c, lower, upper).alias(c) if c in cols else F.col(_q(c))
                       for c in df.columns])


def clip_matching(df: DataFrame, pattern: str, lower=0.0, upper=500.0) -> DataFrame:
    """Coerce to number and clip every column whose name contains ``pattern``."""
    cols = [c for c in df.columns if pattern in c]
    return df.select(*[clip(coerce_double(c), lower, upper).alias(c) if c in cols
                       else F.col(_q(c)) for c in df.columns])


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    return df.select(*[coerce_double(c).alias(c) if c in cols else F.col(_q(c))
                       for c in df.columns])


def sentinel_to_null(df: DataFrame, sentinel: float = SENSOR_SENTINEL, exclude=()) -> DataFrame:
    """Sentinel -> NULL in numeric columns only (string columns untouched)."""
    nums = set(numeric_columns(df, exclude))
    return df.select(*[F.nullif(F.col(_q(c)), F.lit(sentinel)).alias(c) if c in nums
                       else F.col(_q(c)) for c in df.columns])


def pad_features(df: DataFrame, wanted, keep=(), fill: float = 0.0) -> DataFrame:
    """Model-order projection: present columns as double (NULL -> ``fill``), absent -> ``fill``."""
    cols = [F.col(_q(k)) for k in keep]
    for c in wanted:
        if c in df.columns:
            cols.append(F.coalesce(F.col(_q(c)).cast("double"), F.lit(fill)).alias(c))
        else:
            cols.append(F.lit(fill).cast("double").alias(c))
    return df.select(*cols)


def available(df: DataFrame, wanted) -> list[str]:
    """Schema-tolerant selection: the wanted columns that exist, in wanted order."""
    return [c for c in wanted if c in df.columns]


# --- C5, C6, D1: medians and imputation ---------------------------------------------

def impute_median(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """Global median fill per numeric column (C5); all-null columns stay NULL.

    The exact median is distributed (:func:`median_by_key`): no task holds a column's
    values. ``approx=True`` uses ``percentile_approx`` (one bounded aggregate) instead.
    """
    cols = cols if cols is not None else numeric_columns(df)
    if approx:
        med = df.agg(*[F.percentile_approx(F.col(_q(c)), 0.5).cast("double").alias(f"__med_{i}")
                       for i, c in enumerate(cols)])
    else:
        med = medians_wide(df, [], cols).select(
            *[F.col(_q(c)).alias(f"__med_{i}") for i, c in enumerate(cols)])
    s = one_row(med)
    out = [F.coalesce(F.col(_q(c)), s[f"__med_{cols.index(c)}"]).alias(c)
           if c in cols else F.col(_q(c)) for c in df.columns]
    return df.select(*out)


def medians_wide(df: DataFrame, keys: list[str], cols) -> DataFrame:
    """Exact medians of several columns per key in ONE distributed pass: the columns are
    stacked into (key, column, value) rows, ranked together, and pivoted back (the pivot
    values are the given column names, so no extra distinct job)."""
    cols = list(cols)
    stack = "stack({}, {})".format(len(cols), ", ".join(
        f"{i}, CAST({_q(c)} AS DOUBLE)" for i, c in enumerate(cols)))
    long = df.select(*[F.col(_q(k)) for k in keys], F.expr(stack).alias("_ci", "_v"))
    med = median_by_key(long, [*keys, "_ci"], "_v", "_m")
    wide = med.groupBy(*keys).pivot("_ci", list(range(len(cols)))).agg(F.first("_m"))
    return wide.select(*[F.col(_q(k)) for k in keys],
                       *[F.col(str(i)).alias(c) for i, c in enumerate(cols)])


def impute_ffill_median(df: DataFrame, cols=None, key: str = "station",
                        time: str = "datetime", clip_cols=None, mode: str = "auto",
                        chunk_rows: int | None = None,
                        max_distinct: int = 2_000_000) -> DataFrame:
    """Per-key forward fill, then the key's median of the originally non-null values,
    then clip at 0 (D1, C6). Negatives therefore enter the median, as in the reference.

    When every key fits one task and one aggregation buffer (both checked), the median is
    a window aggregate over the same partition as the fill: one shuffle, no join.
    Otherwise the fill runs chunked and the medians come from the distributed form.
    """
    cols = [c for c in (cols if cols is not None else NUMERIC) if c in df.columns]
    clip_cols = [c for c in (clip_cols if clip_cols is not None else POLLUTANTS) if c in cols]

    def finish(filled_cols):
        out = []
        for c in df.columns:
            if c in cols:
                e = filled_cols[c]
                out.append((clip(e, 0.0) if c in clip_cols else e).alias(c))
            else:
                out.append(F.col(_q(c)))
        return out

    kf = keyed_frame(df, [key], [time], halo=0, mode=mode, carry=cols,
                     **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    if not kf.chunked and (mode == "plain" or all(
            v <= max_distinct for v in max_distinct_many(df, [key], cols).values())):
        run = kf.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(key)  # same partitioning: no extra exchange
        filled = {c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(run),
                                F.median(F.col(c)).over(whole)) for c in cols}
        return df.select(*finish(filled))
    # exact, distributed per-key medians of all columns in one pass
    med = medians_wide(df, [key], cols).select(key, *[F.col(c).alias(f"__med_{c}") for c in cols])
    filled = forward_fill(df, cols, key=key, time=time, mode="chunked" if kf.chunked else "plain",
                          chunk_rows=chunk_rows)
    # per-key statistics: AQE broadcasts them from the measured stage size, or splits
    # a skewed key's partition (skewJoin); counting first would recompute the aggregate
    joined = null_safe_join(filled, med, [key], "left")
    return joined.select(*finish({c: F.coalesce(F.col(c), F.col(f"__med_{c}")) for c in cols}))


# --- C7: label encoding -----------------------------------------------------------

def label_encode(df: DataFrame, col: str, out: str | None = None,
                 null_as: str | None = None) -> DataFrame:
    """Code = position in the sorted distinct values (``LabelEncoder``), of any orderable type.

    The dictionary is the distinct values (pre-aggregated), dealt out by ranges and ranked
    inside each range plus the counts of earlier ones, so it is never sorted in one task. It
    is written to the checkpoint folder (both uses must see the same ranges) and joined back
    (AQE broadcasts it when small at runtime). NULL stays NULL unless ``null_as`` names its
    replacement.
    """
    out = out or f"{col}_encoded"
    src = F.coalesce(F.col(col), F.lit(null_as)) if null_as is not None else F.col(col)
    keyed = df.withColumn("__lbl", src)
    values = keyed.select("__lbl").distinct().filter(F.col("__lbl").isNotNull())
    ranged = stored(values.repartitionByRange("__lbl").withColumn("__part", F.spark_partition_id()), "labels")
    ranked = group_positions(ranged, [], F.col("__part"), [F.col("__lbl")], with_size=False)
    dictionary = ranked.select("__lbl", F.col(POS).cast("int").alias(out))
    return keyed.join(dictionary, on="__lbl", how="left").drop("__lbl")


# --- C8, C9: scaling ---------------------------------------------------------------

def scale_standard(df: DataFrame, cols) -> DataFrame:
    """(x - mean) / population std; zero std -> divide by 1; NULL -> 0 first."""
    z = {c: F.coalesce(F.col(_q(c)).cast("double"), F.lit(0.0)) for c in cols}
    stats = df.agg(*[x for c in cols for x in (F.avg(z[c]).alias(f"__mu_{c}"),
                                                F.stddev_pop(z[c]).alias(f"__sd_{c}"))])
    s = one_row(stats)
    out = []
    for c in df.columns:
        if c in cols:
            sd = s[f"__sd_{c}"]
            out.append(((z[c] - s[f"__mu_{c}"]) /
                        F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(c))
        else:
            out.append(F.col(_q(c)))
    return df.select(*out)


def scale_minmax(df: DataFrame, cols) -> DataFrame:
    """(x - min) / (max - min); constant column -> 0; NULL -> 0 first."""
    z = {c: F.coalesce(F.col(_q(c)).cast("double"), F.lit(0.0)) for c in cols}
    stats = df.agg(*[x for c in cols for x in (F.min(z[c]).alias(f"__lo_{c}"),
                                                F.max(z[c]).alias(f"__hi_{c}"))])
    s = one_row(stats)
    out = []
    for c in df.columns:
        if c in cols:
            lo = s[f"__lo_{c}"]
            rng = s[f"__hi_{c}"] - lo
            out.append(F.when(rng == 0, F.lit(0.0)).otherwise((z[c] - lo) / rng).alias(c))
        else:
            out.append(F.col(_q(c)))
    return df.select(*out)


# --- composite cleaning of the three source families --------------------------------

def clean_readings(raw: DataFrame, key: str = "station", mode: str = "auto") -> DataFrame:
    """Station readings: assemble time, ffill + median per station, encode wind, drop date
    parts, clip pollutants at 0 (the reference's preprocessing, in one lazy plan)."""
    df = assemble_timestamp(raw)
    df = impute_ffill_median(df, NUMERIC, key=key, time="datetime", mode=mode)
    if "wd" in df.columns:
        df = label_encode(df, "wd", "wd_encoded", null_as="N")
    return drop_columns(df, ["No", "year", "month", "day", "hour"])


def clean_global_aqi(raw: DataFrame, value_col: str = "AQI Value",
                     category_col: str = "AQI Category") -> DataFrame:
    """Drop rows without value/category, encode category (unknown -> 1), coerce and clip
    every ``AQI Value`` column to [0, 500]."""
    df = drop_null_subset(raw, [value_col, category_col])
    df = df.withColumn("AQI_Label", category_to_code(category_col))
    return clip_matching(df, "AQI Value", 0.0, 500.0)


def clean_sensor(raw: DataFrame, date_col: str = "Date", time_col: str = "Time") -> DataFrame:
    """Sensor file: parse time, sentinel -> NULL, drop columns under half filled, drop
    all-empty rows, median fill, drop the text date/time columns."""
    df = parse_timestamp(raw, date_col, time_col) if date_col in raw.columns else raw
    df = sentinel_to_null(df)
    value_cols = [c for c in df.columns if c not in (date_col, time_col, "datetime")]
    if value_cols:
        df = df.na.drop(how="all", subset=value_cols)
    df = drop_sparse_columns(df, 0.5, drop_all_null=True)
    df = impute_median(df, numeric_columns(df))
    return drop_columns(df, [date_col, time_col])

