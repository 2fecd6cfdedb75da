"""Dimension lookups and membership joins (G1, G3, B16) with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting the side (a cheap action on a dimension).

    Past the bound the side is left to the planner: a shuffled join, which AQE may still
    convert at runtime from measured sizes.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return big.join(bounded_broadcast(small, max_rows), on=on, how=how)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match NULL keys; the key columns are those of ``left``."""
    names = {k: f"_right_{k}" for k in on}
    right = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    same = F.lit(True)
    for k, r in names.items():
        same = same & F.col(k).eqNullSafe(F.col(r))
    return left.join(right, same, how).drop(*names.values())


def allowed(df: DataFrame, stations: DataFrame, key: str, station_key: str | None = None,
            max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is in the station list (left semi join)."""
    s = stations.select(F.col(station_key or key).alias(key))
    return df.join(bounded_broadcast(s, max_rows), on=key, how="left_semi")


def rejected(df: DataFrame, stations: DataFrame, key: str, station_key: str | None = None,
             max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is not in the station list (left anti join)."""
    s = stations.select(F.col(station_key or key).alias(key))
    return df.join(bounded_broadcast(s, max_rows), on=key, how="left_anti")
