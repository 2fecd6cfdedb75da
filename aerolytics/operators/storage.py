"""Size-aware caching of derived tables that are read many times (ML inputs, profiles,
hourly series).

A cached plan keeps the partitioning it was computed with (adaptive execution does not
coalesce it), so a 100-row profile produced by a 200-partition shuffle would make every
iteration of an iterative learner launch 200 tasks. ``sized_cache`` materialises the table
once, counts it, and keeps about ``rows_per_partition`` rows per partition (never more
partitions than the table had): small tables become one partition, large ones keep their
parallelism.
"""

from __future__ import annotations

import math
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from aerolytics.session import ensure_checkpoint_dir

DEFAULT_ROWS_PER_PARTITION = 1_000_000


def sized_cache(df: DataFrame, rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION,
                level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    cached = df.persist(level)
    n = cached.count()
    target = max(1, math.ceil(n / rows_per_partition))
    if cached.rdd.getNumPartitions() <= target:
        return cached
    compact = cached.coalesce(target).persist(level)
    compact.count()
    cached.unpersist()
    return compact


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back: the lineage ends
    there, and unlike ``checkpoint()`` the rows are computed once and stay columnar."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
