"""Registry of named queries: a Spark builder and (when SQL can express it) a DuckDB oracle.

Doubles are rounded to 6 places (and -0.0 folded into 0.0) in both engines before the
driver hashes values; every computed column carries the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerolytics.functions.scalar import r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: ``@register("key", oracle=SQL)`` on ``fn(spark, sf_dir) -> DataFrame``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Apply :func:`r6` to every double/float column (comparison form)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(r6(df[f.name]).alias(f.name) if places == 6 else df[f.name])
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def R6(expr: str) -> str:
    """SQL twin of :func:`r6`."""
    return f"(round({expr}, 6) + 0.0)"
