"""Repeatable sampling and splits.

Randomness comes from ``md5`` of a row key, so every engine (and every retry of a lost
task) picks the same rows. Per-group top-k uses ``row_number() <= k``, which Spark plans
as ``WindowGroupLimit`` with a partial limit before the shuffle.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.operators.joins import null_safe_join
from aerolytics.operators.keyed import POS, group_positions


def hash_order(id_col: str) -> Column:
    return F.md5(F.col(id_col).cast("string"))


def hash_fraction(id_col: str) -> Column:
    """Integer 0..9 from the first 8 hex digits of md5(key)."""
    return F.conv(F.substr(hash_order(id_col), F.lit(1), F.lit(8)), 16, 10).cast("long") % 10


def sample_per_group(df: DataFrame, key: str, id_col: str, n: int) -> DataFrame:
    """Up to ``n`` rows per group, chosen by md5 order (stratified downsample, E3)."""
    w = Window.partitionBy(key).orderBy(hash_order(id_col), F.col(id_col))
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def sample_n(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """Fixed-size repeatable sample (E4): ``TakeOrderedAndProject`` on md5(key)."""
    return df.orderBy(hash_order(id_col), F.col(id_col)).limit(n)


def split_hash(df: DataFrame, id_col: str, test_tenths: int = 2) -> DataFrame:
    """80/20 split (E5): ``is_test`` when the md5 digit is below ``test_tenths``."""
    return df.withColumn("is_test", hash_fraction(id_col) < test_tenths)


def split_stratified(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     prefix_digits: int = 3) -> DataFrame:
    """Stratified split (E6): inside each label, rows ranked by md5(key); ``is_test`` when
    ``percent_rank < test_fraction``.

    The rank is exact and distributed: rows are ranked inside (label, md5 prefix) buckets
    and offset by the counts of earlier buckets, so no label is sorted in one task.
    """
    h = hash_order(id_col)
    pos = group_positions(df, [label], F.substr(h, F.lit(1), F.lit(prefix_digits)),
                          [h, F.col(id_col)], with_size=True)
    pr = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(F.col(POS) / (F.col("_n") - 1))
    return pos.withColumn("is_test", pr < F.lit(test_fraction)).drop(POS, "_n")


def split_time(df: DataFrame, key: str, time: str, test_fraction: float = 0.2) -> DataFrame:
    """Time-ordered split (E7): per key, rows after ``min + (1 - f) * (max - min)`` are test.

    Only a per-key (min, max) aggregate is joined back, so no future row leaks into the
    training side of its own series.
    """
    b = df.groupBy(key).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    train = Fraction(1 - test_fraction).limit_denominator(1000)
    span = F.timestamp_diff("MICROSECOND", F.col("_lo"), F.col("_hi"))
    # integer arithmetic: the cut is exact and repeatable across engines
    offset = (span * F.lit(train.numerator)).cast("long") / F.lit(train.denominator)
    cut = F.timestamp_add("MICROSECOND", F.floor(offset).cast("long"), F.col("_lo"))
    # per-key statistics: AQE broadcasts them from the measured stage size, or splits
    # a skewed key's partition (skewJoin); counting first would recompute the aggregate
    return (null_safe_join(df, b, [key])
            .withColumn("is_test", F.col(time) > cut).drop("_lo", "_hi"))


def holdout_tail(df: DataFrame, key: str, time: str, horizon: int = 24,
                 min_points: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Last ``horizon`` points of each series are test.

    Returns (flagged rows of series with at least ``min_points`` rows, rejected keys with
    their counts). The tail is a per-key top-k (partial limit before the shuffle); its
    first time is the cutoff joined back on the key.
    """
    min_points = min_points if min_points is not None else 2 * horizon
    # a total order (ties in time by a hash of the row): exactly ``horizon`` rows are test
    last = F.struct(F.col(time), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    w = Window.partitionBy(key).orderBy(last.desc())
    tail = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= horizon)
    cut = tail.groupBy(key).agg(F.min(last).alias("_cut"))
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"))
    ok = null_safe_join(sizes.filter(F.col("n_points") >= min_points), cut, [key])
    # per-key statistics: AQE broadcasts them from the measured stage size, or splits
    # a skewed key's partition (skewJoin); counting first would recompute the aggregate
    flagged = (null_safe_join(df, ok, [key])
               .withColumn("is_test", last >= F.col("_cut")).drop("_cut", "n_points"))
    rejected = sizes.filter(F.col("n_points") < min_points)
    return flagged, rejected
