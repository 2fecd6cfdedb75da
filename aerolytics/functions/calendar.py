"""Calendar and cyclical encodings (F1, F2) plus time truncation helpers (F8)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CYCLES = (("hour", 24), ("month", 12), ("dow", 7))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_columns(ts) -> list[Column]:
    """hour, month, dayofweek (Monday = 0), dayofyear and six sin/cos columns."""
    t = _col(ts)
    hour = F.hour(t)
    month = F.month(t)
    dow = F.weekday(t)  # Monday = 0, like pandas dayofweek
    cols = [hour.alias("hour"), month.alias("month"), dow.alias("dayofweek"),
            F.dayofyear(t).alias("dayofyear")]
    for name, expr, period in (("hour", hour, 24), ("month", month, 12), ("dow", dow, 7)):
        angle = F.lit(2 * math.pi) * expr / F.lit(period)
        cols += [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]
    return cols


CALENDAR_NAMES = ["hour", "month", "dayofweek", "dayofyear", "hour_sin", "hour_cos",
                  "month_sin", "month_cos", "dow_sin", "dow_cos"]


def trunc_ntz(unit: str, ts) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (Spark returns TIMESTAMP for NTZ input)."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def week_ending_sunday(ts) -> Column:
    """Label of the Monday..Sunday week holding ``ts``: the date of its Sunday."""
    return F.date_add(F.to_date(F.date_trunc("week", _col(ts))), 6)


def hour_window_label(hour) -> Column:
    """``HH:00 – HH:00`` label; hour 23 ends at ``24:00``."""
    h = _col(hour).cast("int")
    return F.format_string("%02d:00 – %02d:00", h, h + 1)


def ntz_to_instant(ts) -> Column:
    """Naive wall-clock -> instant, read as UTC whatever the session zone (for watermarks
    and event-time windows, which need TIMESTAMP)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, _col(ts)))


def instant_to_ntz(ts) -> Column:
    """Inverse of :func:`ntz_to_instant` (UTC wall-clock, session-zone independent)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch)
