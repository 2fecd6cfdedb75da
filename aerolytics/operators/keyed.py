"""Row-ordered windows per key that stay parallel when one key is huge.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task. That
is right for many moderate keys, and wrong when one station (or the ungrouped case, where
the whole table is one key) holds a large share of the rows. Row-based lags and rolling
frames only look back a bounded number of rows (``halo``), so the work splits exactly:

1. ``pos`` = global row number of each row inside its key, computed without a global
   sort: row_number inside (key, time bucket) plus the running count of earlier buckets
   (a small pre-aggregated table, one row per (key, bucket)). Buckets are per-key
   approximate time quantiles, so they stay balanced even if a third of a key's rows
   fall on one day.
2. ``chunk = pos div chunk_rows``; the last ``halo`` rows of every chunk are copied into
   the next chunk as ghost rows, so a frame of up to ``halo`` preceding rows is complete.
3. The feature window runs on ``partitionBy(key, chunk).orderBy(pos)``; ghosts are
   dropped afterwards.

Unbounded frames (forward fill) carry the last non-null value of earlier chunks in from
a per-chunk aggregate. ``mode="auto"`` checks the largest key with one count aggregate
and only pays for chunking when a key exceeds ``max_rows_per_task``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.operators.joins import null_safe_join

POS = "_pos"
CHUNK = "_chunk"
GHOST = "_ghost"
BUCKET = "_bucket"

DEFAULT_MAX_ROWS_PER_TASK = 20_000_000
DEFAULT_CHUNK_ROWS = 1_000_000


@dataclass
class KeyedFrame:
    """A DataFrame prepared for row-ordered windows per key, plain or chunked."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    chunked: bool
    helper_cols: list[str] = field(default_factory=list)

    @property
    def window(self):
        if self.chunked:
            return Window.partitionBy(*[F.col(k) for k in self.keys], F.col(CHUNK)).orderBy(POS)
        w = Window.partitionBy(*[F.col(k) for k in self.keys]) if self.keys else Window
        return w.orderBy(*[F.col(o) for o in self.order])

    def finish(self, out: DataFrame) -> DataFrame:
        """Drop ghost rows and helper columns after the window select."""
        if self.chunked:
            out = out.filter(~F.col(GHOST))
        return out.drop(*[c for c in self.helper_cols if c in out.columns])

    def carry_last(self, value: str) -> Column | None:
        """Column of the last non-null ``value`` from earlier chunks (chunked mode only)."""
        return F.col(f"_carry_{value}") if self.chunked else None


_CHECKS: dict = {}


def _memo(kind: str, df: DataFrame, keys, compute):
    """Remember a strategy check per input plan (semantic hash). A check only chooses
    between two plans that give identical results, so a stale answer costs time, never
    correctness."""
    k = (kind, df.semanticHash(), tuple(keys))
    if k not in _CHECKS:
        _CHECKS[k] = compute()
    return _CHECKS[k]


def _largest_key(df: DataFrame, keys: list[str]) -> int:
    if keys:
        return df.groupBy(*keys).count().agg(F.max("count").alias("m")).first()["m"] or 0
    return df.count()


def choose_chunked(df: DataFrame, keys: list[str], max_rows_per_task: int) -> bool:
    """One small aggregate: is any key larger than what one task should sort?"""
    biggest = _memo("rows", df, keys, lambda: _largest_key(df, keys))
    return bool(biggest and biggest > max_rows_per_task)


def keyed_frame(df: DataFrame, keys: list[str], order: list[str], halo: int,
                mode: str = "auto", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                groups: int = 16, carry: list[str] | None = None,
                max_rows_per_task: int = DEFAULT_MAX_ROWS_PER_TASK) -> KeyedFrame:
    """Prepare ``df`` for windows ordered by ``order`` within ``keys``.

    ``order[0]`` must be a timestamp (it defines the buckets); further order columns
    break ties. ``carry`` lists columns whose last non-null value of earlier chunks is
    needed (forward fill).
    """
    if mode not in ("auto", "plain", "chunked"):
        raise ValueError(f"unknown mode {mode!r}")
    chunked = mode == "chunked" or (mode == "auto" and choose_chunked(df, keys, max_rows_per_task))
    if not chunked:
        return KeyedFrame(df, keys, order, False)
    if chunk_rows < halo:
        raise ValueError("chunk_rows must be at least the halo")

    bounded = with_time_bounds(df, keys, order[0], groups)
    positioned = group_positions(bounded, keys, time_bucket(order[0], groups),
                                 [F.col(o) for o in order], with_size=False).drop("_bounds")
    base_chunk = F.floor(F.col(POS) / F.lit(chunk_rows)).cast("long")
    in_halo = (F.col(POS) % F.lit(chunk_rows)) >= F.lit(chunk_rows - halo)
    shift = F.explode(F.when(in_halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ghosted = (positioned.withColumn("_shift", shift)
               .withColumn(CHUNK, base_chunk + F.col("_shift"))
               .withColumn(GHOST, F.col("_shift") == 1)
               .drop("_shift"))
    key_cols = [F.col(k) for k in keys]
    helpers = [POS, CHUNK, GHOST]
    if carry:
        real = ghosted.filter(~F.col(GHOST))
        last_in_chunk = real.groupBy(*keys, CHUNK).agg(*[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_last_{c}")
            for c in carry])
        prev_w = (Window.partitionBy(*key_cols) if keys else Window).orderBy(CHUNK) \
            .rowsBetween(Window.unboundedPreceding, -1)
        carries = last_in_chunk.select(*keys, CHUNK, *[
            F.last(F.col(f"_last_{c}"), ignorenulls=True).over(prev_w).alias(f"_carry_{c}")
            for c in carry])
        ghosted = null_safe_join(ghosted, carries, [*keys, CHUNK], "left")
        helpers += [f"_carry_{c}" for c in carry]
    return KeyedFrame(ghosted, keys, order, True, helpers)


def _micros(time: str) -> Column:
    """Zone-independent microseconds of a timestamp (naive or not) for bucketing."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(time).cast("timestamp_ntz"))


def with_time_bounds(df: DataFrame, keys: list[str], time: str, groups: int = 16) -> DataFrame:
    """Add ``_bounds``: ``groups**2 - 1`` approximate quantiles of each key's times (one
    bounded aggregate per key; joined on the key, AQE broadcasts it when small)."""
    n = groups * groups
    fracs = F.array(*[F.lit(i / n) for i in range(1, n)])
    bounds = df.groupBy(*keys).agg(F.percentile_approx(_micros(time), fracs, 10_000).alias("_bounds"))
    if keys:
        return null_safe_join(df, bounds, keys)
    return df.withColumn("_bounds", bounds.select("_bounds").scalar())


def time_bucket(time: str, groups: int = 16) -> Column:
    """Balanced, monotone time bucket from ``_bounds`` (see :func:`with_time_bounds`)."""
    return bucket_of(F.col("_bounds"), _micros(time), groups)


def group_positions(df: DataFrame, keys: list[str], bucket: Column, order: list[Column],
                    with_size: bool = True) -> DataFrame:
    """Add ``_pos`` (0-based rank of each row inside its key by ``order``) and, optionally,
    ``_n`` (rows in the key) without sorting any whole key in one task.

    ``bucket`` must be monotone in ``order`` (a time truncation, a hash prefix). Rows are
    ranked inside (key, bucket); the running count of earlier buckets comes from a small
    pre-aggregated table with one row per (key, bucket).
    """
    key_cols = [F.col(k) for k in keys]
    bucketed = df.withColumn(BUCKET, bucket)
    rn_w = Window.partitionBy(*key_cols, F.col(BUCKET)).orderBy(*order)
    counts = bucketed.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_bn"))
    by_key = Window.partitionBy(*key_cols) if keys else Window
    offsets = counts.select(
        *keys, BUCKET,
        F.coalesce(F.sum("_bn").over(by_key.orderBy(BUCKET).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *([F.sum("_bn").over(by_key.rowsBetween(Window.unboundedPreceding,
                                                Window.unboundedFollowing)).alias("_n")]
          if with_size else []))
    return (null_safe_join(bucketed.withColumn("_rn", F.row_number().over(rn_w)), offsets, [*keys, BUCKET])
            .withColumn(POS, F.col("_off") + F.col("_rn") - 1)
            .drop("_rn", "_off", BUCKET))


def running_totals(df: DataFrame, keys: list[str], order: str, cols: list[str],
                   groups: int = 16, accuracy: int = 10_000, mode: str = "auto",
                   max_rows_per_task: int = DEFAULT_MAX_ROWS_PER_TASK) -> DataFrame:
    """Exact running sums of ``cols`` in ``order`` inside each key, plus key totals.

    Adds ``cum_{c}`` (sum over rows up to and including this one) and ``tot_{c}``. Rows
    must be unique in (keys, order) — pre-aggregate first. Balanced monotone buckets come
    from approximate quantiles (a bounded aggregate); the exact running sum is a window
    inside (key, bucket) plus the totals of earlier buckets, so no key is ordered in one
    task however many distinct values it has.
    """
    key_cols = [F.col(k) for k in keys]
    by_key = Window.partitionBy(*key_cols) if keys else Window
    if mode not in ("auto", "plain", "bucketed"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "plain" or (mode == "auto" and not choose_chunked(df, keys, max_rows_per_task)):
        # every key fits one task (checked): one window per key
        run = by_key.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.select("*", *[F.sum(c).over(run).alias(f"cum_{c}") for c in cols],
                         *[F.sum(c).over(whole).alias(f"tot_{c}") for c in cols])
    n_buckets = groups * groups  # 256 balanced buckets by default
    fracs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    bounds = df.groupBy(*keys).agg(
        F.percentile_approx(F.col(order), fracs, accuracy).alias("_bounds"))
    b = bucket_of(F.col("_bounds"), F.col(order), groups)
    # one row per key; AQE broadcasts it from the measured stage size or splits a hot
    # key's partition (skew join), so no key is pulled into one task by this join
    bucketed = (null_safe_join(df, bounds, keys) if keys
                else df.withColumn("_bounds", bounds.select("_bounds").scalar())) \
        .withColumn(BUCKET, b).drop("_bounds")
    in_bucket = Window.partitionBy(*key_cols, F.col(BUCKET)).orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_bucket = bucketed.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(f"_b_{c}") for c in cols])
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_bucket.select(*keys, BUCKET, *[
        x for c in cols for x in (
            F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_off_{c}"),
            F.sum(f"_b_{c}").over(whole).alias(f"tot_{c}"))])
    running = bucketed.select("*", *[F.sum(c).over(in_bucket).alias(f"_run_{c}") for c in cols])
    out = null_safe_join(running, offsets, [*keys, BUCKET])
    return out.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_run_{c}")).alias(f"cum_{c}")
                                     for c in cols], *[f"tot_{c}" for c in cols])


def median_by_key(df: DataFrame, keys: list[str], col: str, out: str = "median",
                  mode: str = "auto", max_distinct: int = 2_000_000) -> DataFrame:
    """Exact median per key (mean of the two middle values for an even count), without
    holding a key's values in one task.

    Values are pre-aggregated to (key, value) counts, ranked by :func:`running_totals`,
    and the median is read at ranks floor((n+1)/2) and floor(n/2)+1. NULLs are ignored;
    a key with no values gets no row. ``mode="auto"`` first bounds the distinct values
    per key (HyperLogLog); the built-in exact ``median`` aggregate is used when they fit
    one buffer, the distributed form otherwise.
    """
    if mode == "aggregate" or (mode == "auto" and _memo(f"distinct:{col}", df, keys,
                                                        lambda: _max_distinct(df, keys, col))
                               <= max_distinct):
        # checked: every key's distinct values fit one aggregation buffer
        agg = [F.median(F.col(col)).cast("double").alias(out)]
        return df.groupBy(*keys).agg(*agg) if keys else df.agg(*agg)
    counts = (df.filter(F.col(col).isNotNull()).groupBy(*keys, col)
              .agg(F.count(F.lit(1)).alias("_c")))
    run = running_totals(counts, keys, col, ["_c"], mode="bucketed")
    r1 = F.floor((F.col("tot__c") + 1) / 2)
    r2 = F.floor(F.col("tot__c") / 2) + 1
    picked = [F.min(F.when(F.col("cum__c") >= r1, F.col(col))).alias("_v1"),
              F.min(F.when(F.col("cum__c") >= r2, F.col(col))).alias("_v2")]
    agg = run.groupBy(*keys).agg(*picked) if keys else run.agg(*picked)
    return agg.select(*keys, (F.col("_v1") + (F.col("_v2") - F.col("_v1")) * 0.5)
                      .cast("double").alias(out))


def _rank_in_sorted(arr: Column, v: Column, lo: int, hi: int, base: Column | None = None,
                    stride: int = 1, offset: int = 0) -> Column:
    """Number of elements below ``v`` among the ascending elements
    ``arr[base + offset + stride*i]`` for i in [lo, hi), plus ``lo``; a binary search
    unrolled into nested CASE WHEN (compiled by codegen, no per-row lambda)."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    idx = F.lit(offset + stride * mid + 1) if base is None else base + F.lit(offset + stride * mid + 1)
    return F.when(F.element_at(arr, idx) < v,
                  _rank_in_sorted(arr, v, mid + 1, hi, base, stride, offset)) \
        .otherwise(_rank_in_sorted(arr, v, lo, mid, base, stride, offset))


def bucket_of(bounds: Column, v: Column, groups: int) -> Column:
    """Exact rank of ``v`` in ``groups**2 - 1`` ascending bounds (0..groups**2-1) by a
    two-level search: first among every ``groups``-th bound, then inside that slice —
    about 2*groups CASE nodes instead of groups**2."""
    g = groups
    coarse = _rank_in_sorted(bounds, v, 0, g - 1, stride=g, offset=g - 1)
    base = coarse * F.lit(g)
    fine = _rank_in_sorted(bounds, v, 0, g - 1, base=base)
    return base + fine


def _max_distinct(df: DataFrame, keys: list[str], col: str) -> int:
    """Upper estimate of the distinct values of ``col`` in the largest key (one aggregate)."""
    est = F.approx_count_distinct(F.col(col), 0.05)
    row = (df.groupBy(*keys).agg(est.alias("_d")).agg(F.max("_d").alias("m")) if keys
           else df.agg(est.alias("m"))).first()
    return int(1.1 * (row["m"] or 0))


def max_distinct_per_key(df: DataFrame, keys: list[str], col: str) -> int:
    """Memoised upper estimate of the distinct values of ``col`` in the largest key."""
    return _memo(f"distinct:{col}", df, keys, lambda: _max_distinct(df, keys, col))


def max_distinct_many(df: DataFrame, keys: list[str], cols) -> dict[str, int]:
    """Upper estimates for several columns from ONE aggregate (memoised per plan)."""
    cols = list(cols)

    def compute():
        est = [F.approx_count_distinct(F.col(c), 0.05).alias(f"_d{i}") for i, c in enumerate(cols)]
        if keys:
            per = df.groupBy(*keys).agg(*est)
            row = per.agg(*[F.max(f"_d{i}").alias(f"_d{i}") for i in range(len(cols))]).first()
        else:
            row = df.agg(*est).first()
        return {c: int(1.1 * (row[f"_d{i}"] or 0)) for i, c in enumerate(cols)}

    return _memo("distinct-many:" + ",".join(cols), df, keys, compute)
