"""Feature build (D2-D8, F1-F2, B17): calendar, row-based lags, rolling mean/std, labels.

All lags and frames of one build share one window spec, so the plan has one Exchange,
one Sort and one Window node (or the chunked form of :mod:`aerolytics.operators.keyed`
when a key is too big for one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.constants import PM10_LAGS, PM25_LAGS, ROLLING_WINDOWS
from aerolytics.functions.aqi import aqi_category, aqi_code
from aerolytics.functions.calendar import calendar_columns
from aerolytics.operators.keyed import keyed_frame


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def add_calendar_features(df: DataFrame, time: str = "datetime") -> DataFrame:
    """hour, month, dayofweek (Mon=0), dayofyear and sin/cos of hour/24, month/12, dow/7."""
    return df.select("*", *calendar_columns(time))


def lag_columns(target: str, lags, w):
    return [F.lag(F.col(target), k).over(w).alias(f"{target}_lag{k}") for k in lags]


def rolling_columns(target: str, windows, w):
    """Mean and sample std over the previous ``n`` rows (current row excluded).

    pandas ``shift(1).rolling(n, min_periods=1)``: NULL when no prior non-null value;
    std of 0 or 1 values is NULL, filled with 0.
    """
    cols = []
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        cols.append(F.avg(F.col(target)).over(frame).alias(f"{target}_roll_mean{n}"))
        cols.append(F.coalesce(F.stddev_samp(F.col(target)).over(frame), F.lit(0.0))
                    .alias(f"{target}_roll_std{n}"))
    return cols


def add_lag_features(df: DataFrame, target: str, lags=PM25_LAGS, key="station",
                     time: str = "datetime", order_extra=(), mode: str = "auto",
                     chunk_rows: int | None = None) -> DataFrame:
    """``{target}_lag{k}``: value k rows earlier within the key (row based, not time based).

    ``key=None`` gives the ungrouped form (D6), which always runs chunked past one task.
    """
    kf = keyed_frame(df, _keys(key), [time, *order_extra], halo=max(lags), mode=mode,
                     **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    return kf.finish(kf.df.select("*", *lag_columns(target, lags, kf.window)))


def add_rolling_features(df: DataFrame, target: str, windows=ROLLING_WINDOWS, key="station",
                         time: str = "datetime", order_extra=(), mode: str = "auto",
                         chunk_rows: int | None = None) -> DataFrame:
    kf = keyed_frame(df, _keys(key), [time, *order_extra], halo=max(windows), mode=mode,
                     **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    return kf.finish(kf.df.select("*", *rolling_columns(target, windows, kf.window)))


def add_aqi_label(df: DataFrame, pm25: str = "pm25", null_label: int | None = 5) -> DataFrame:
    return df.select("*", aqi_category(pm25, null_label).alias("aqi_category"),
                     aqi_code(pm25, null_label).alias("aqi_label"))


def build_features(df: DataFrame, key="station", time: str = "datetime", target: str = "pm25",
                   lags=PM25_LAGS, windows=ROLLING_WINDOWS, extra_lags: dict | None = None,
                   drop_warmup: bool = True, calendar: bool = True, label: bool = True,
                   order_extra=(), mode: str = "auto", chunk_rows: int | None = None,
                   null_label: int | None = 5) -> DataFrame:
    """Complete feature build (D8) in one window pass.

    ``extra_lags`` defaults to PM10 lags 1, 6, 24 when a ``pm10`` column exists.
    Warm-up rows (``lag1`` or ``lag24`` NULL) are dropped, as in the reference.
    """
    if extra_lags is None:
        extra_lags = {"pm10": PM10_LAGS} if "pm10" in df.columns else {}
    halo = max([*lags, *windows, *[max(v) for v in extra_lags.values()]])
    kf = keyed_frame(df, _keys(key), [time, *order_extra], halo=halo, mode=mode,
                     **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    w = kf.window
    # only the window outputs are computed under the window; row-local calendar and label
    # columns come after it, so the shuffle carries the narrow input rows
    cols = ["*", *lag_columns(target, lags, w)]
    for col, ks in extra_lags.items():
        cols += lag_columns(col, ks, w)
    cols += rolling_columns(target, windows, w)
    post = []
    if calendar:
        post += calendar_columns(time)
    if label:
        post += [aqi_category(target, null_label).alias("aqi_category"),
                 aqi_code(target, null_label).alias("aqi_label")]
    windowed = kf.finish(kf.df.select(*cols))
    if drop_warmup:
        first, last = min(lags), max(lags)
        windowed = windowed.filter(F.col(f"{target}_lag{first}").isNotNull()
                                   & F.col(f"{target}_lag{last}").isNotNull())
    base = [c for c in df.columns]
    feats = [c for c in windowed.columns if c not in base]
    out = windowed.select(*base, *post, *feats)
    return out


def forward_fill(df: DataFrame, cols, key="station", time: str = "datetime", order_extra=(),
                 mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """Per-key forward fill in time order (unbounded frame, chunk-carried when chunked)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    kf = keyed_frame(df, _keys(key), [time, *order_extra], halo=0, mode=mode, carry=cols,
                     **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    w = kf.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = []
    for c in cols:
        e = F.last(F.col(c), ignorenulls=True).over(w)
        carry = kf.carry_last(c)
        if carry is not None:
            e = F.coalesce(e, carry)
        filled.append(e.alias(c))
    others = [F.col(c) for c in kf.df.columns if c not in cols]
    return kf.finish(kf.df.select(*others, *filled)).select(*df.columns)
