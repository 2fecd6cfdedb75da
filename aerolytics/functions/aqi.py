"""AQI category expressions: breakpoint labels, text <-> code maps. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolytics.constants import (AQI_CATEGORIES, PM25_BREAKPOINTS, SAFE_CATEGORIES,
                                  UNKNOWN_CATEGORY_CODE, UNKNOWN_TEXT)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def aqi_code(pm25, null_label: int | None = 5) -> Column:
    """Upper-inclusive breakpoint code 0..5.

    A NULL reading falls through every ``<=`` test, as in the reference, and lands on the
    last code (Hazardous) unless ``null_label`` says otherwise.
    """
    x = _col(pm25)
    expr = None
    for code, upper in enumerate(PM25_BREAKPOINTS):
        expr = (F.when(x <= F.lit(upper), F.lit(code)) if expr is None
                else expr.when(x <= F.lit(upper), F.lit(code)))
    last = len(PM25_BREAKPOINTS)
    if null_label is None:
        expr = expr.when(x.isNull(), F.lit(None).cast("int"))
    elif null_label != last:
        expr = expr.when(x.isNull(), F.lit(null_label))
    return expr.otherwise(F.lit(last)).cast("int")


def aqi_category(pm25, null_label: int | None = 5) -> Column:
    """Breakpoint category text (same when chain as :func:`aqi_code`)."""
    x = _col(pm25)
    expr = None
    for name, upper in zip(AQI_CATEGORIES, PM25_BREAKPOINTS):
        expr = (F.when(x <= F.lit(upper), F.lit(name)) if expr is None
                else expr.when(x <= F.lit(upper), F.lit(name)))
    if null_label is None:
        expr = expr.when(x.isNull(), F.lit(None).cast("string"))
    elif null_label != len(PM25_BREAKPOINTS):
        expr = expr.when(x.isNull(), F.lit(AQI_CATEGORIES[null_label]))
    return expr.otherwise(F.lit(AQI_CATEGORIES[-1]))


def category_map() -> Column:
    """Literal text -> code map (folded into the plan, no join)."""
    pairs = []
    for code, name in enumerate(AQI_CATEGORIES):
        pairs += [F.lit(name), F.lit(code)]
    return F.create_map(*pairs)


def category_to_code(category, unknown: int = UNKNOWN_CATEGORY_CODE) -> Column:
    """Category text -> code; unknown or NULL text -> ``unknown`` (Moderate)."""
    return F.coalesce(F.try_element_at(category_map(), _col(category)),
                      F.lit(unknown)).cast("int")


def code_to_category(code, default: str = UNKNOWN_TEXT) -> Column:
    """Code -> text with a default for codes outside 0..5."""
    names = F.array(*[F.lit(n) for n in AQI_CATEGORIES])
    c = _col(code).cast("int")
    return F.coalesce(
        F.when((c >= 0) & (c < len(AQI_CATEGORIES)), F.element_at(names, c + 1)),
        F.lit(default))


def is_safe(category) -> Column:
    """0/1 flag: category is one of the safe categories."""
    return _col(category).isin(*SAFE_CATEGORIES).cast("int")
