"""Scalar helpers: clipping, coercion, sentinels, rounding. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lower: float | None = None, upper: float | None = None) -> Column:
    """NULL-preserving clip. ``greatest(0, NULL)`` would return 0, so use ``when``."""
    x = _col(c)
    out = None
    if lower is not None:
        out = F.when(x < F.lit(lower), F.lit(lower))
    if upper is not None:
        out = (F.when(x > F.lit(upper), F.lit(upper)) if out is None
               else out.when(x > F.lit(upper), F.lit(upper)))
    return x if out is None else out.otherwise(x)


def coerce_double(c) -> Column:
    """Text -> double; unparsable text -> NULL (``to_numeric(errors='coerce')``)."""
    return F.expr(f"try_cast({_sql_name(c)} as double)") if isinstance(c, str) else c.try_cast("double")


def decimal_comma_double(c) -> Column:
    """Parse ``1,5`` style numbers."""
    return F.regexp_replace(_col(c), ",", ".").try_cast("double")


def sentinel_to_null(c, sentinel: float) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def nonneg(c) -> Column:
    """max(0, x) for values that are never NULL (predictions)."""
    return F.greatest(_col(c), F.lit(0.0))


def r6(c) -> Column:
    """Round to 6 places and fold -0.0 into 0.0 (the oracle does the same)."""
    return F.round(_col(c), 6) + F.lit(0.0)


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def one_row(stats) -> Column:
    """A one-row statistics DataFrame as ONE scalar subquery returning a struct; read its
    fields with ``s[name]``. Every field reference reuses the same subquery (computed
    once, inlined as a value), so there is no join and no repeated scan."""
    return stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns]).alias("s")).scalar()
