"""Data-quality rules and drift statistics (I1-I8, C15) as aggregate queries.

Every rule set is evaluated in ONE aggregate pass (a single row of counters) and then
unpivoted into report rows (rule, column, observed, passed), so a report over a 100 TB
table is one scan with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.constants import AQI_CATEGORIES
from aerolytics.operators.keyed import running_totals


def require_columns(df: DataFrame, required) -> list[str]:
    """Missing required columns (empty list when the schema is complete)."""
    return [c for c in required if c not in df.columns]


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def quality_report(df: DataFrame, measures, label: str | None = None,
                   category: str | None = None, cyclic=(), key: str | None = None,
                   min_rows: int = 1, min_keys: int = 1, max_null_rate: float = 0.3,
                   nonneg=(), sentinel: float | None = None) -> DataFrame:
    """Rule report: not-all-null and null rate per measure (I2, I3), negatives (I4),
    label / category / cyclical ranges (I5), row and key counts (I6, C15), sentinel
    values left in the data (I7)."""
    aggs, rules = [], []

    def add(rule, col, expr, passed_sql):
        i = len(aggs)
        aggs.append(expr.cast("double").alias(f"_m{i}"))
        rules.append((rule, col, f"_m{i}", passed_sql))

    for c in measures:
        add("not_all_null", c, F.count(F.col(_q(c))), "{} > 0")
        add("null_rate", c, F.avg(F.col(_q(c)).isNull().cast("double")), f"{{}} < {max_null_rate}")
    for c in nonneg:
        add("no_negatives", c, F.count_if(F.col(_q(c)) < 0), "{} = 0")
    if sentinel is not None:
        for c in measures:
            add("no_sentinel", c, F.count_if(F.col(_q(c)) == sentinel), "{} = 0")
    if label:
        add("label_range", label, F.count_if(~F.col(label).between(0, len(AQI_CATEGORIES) - 1)
                                             | F.col(label).isNull()), "{} = 0")
    if category:
        add("category_valid", category, F.count_if(~F.col(category).isin(*AQI_CATEGORIES)
                                                   | F.col(category).isNull()), "{} = 0")
    for c in cyclic:
        add("cyclic_range", c, F.count_if(~F.col(c).between(-1.01, 1.01)), "{} = 0")
    add("row_count", "*", F.count(F.lit(1)), f"{{}} >= {min_rows}")
    if key:
        add("key_count", key, F.countDistinct(F.col(key)), f"{{}} >= {min_keys}")
    row = df.agg(*aggs)
    stack = "stack({}, {})".format(len(rules), ", ".join(
        f"'{r}', '{c}', {m}, {p.format(m)}" for r, c, m, p in rules))
    return row.select(F.expr(stack).alias("rule", "column", "observed", "passed"))


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Exact duplicates over ``cols``: one row per duplicated tuple with its copy count."""
    cols = list(cols or df.columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_copies"))
            .filter(F.col("n_copies") > 1))


def constant_columns(df: DataFrame) -> DataFrame:
    """Per column: constant (at most one distinct non-null value) from min = max, one pass."""
    aggs = []
    for c in df.columns:
        aggs += [F.min(F.col(_q(c))).alias(f"_lo_{len(aggs)}"), F.max(F.col(_q(c))).alias(f"_hi_{len(aggs) + 1}")]
    row = df.agg(*aggs)
    parts = []
    for i, c in enumerate(df.columns):
        lo, hi = f"_lo_{2 * i}", f"_hi_{2 * i + 1}"
        parts.append(f"'{c}', coalesce({lo} = {hi}, true)")
    return row.select(F.expr(f"stack({len(df.columns)}, {', '.join(parts)})")
                      .alias("column", "is_constant"))


def to_long(df: DataFrame, features, keep=()) -> DataFrame:
    """Wide features -> (keep..., feature, value) rows."""
    stack = "stack({}, {})".format(len(features), ", ".join(
        f"'{f}', CAST({_q(f)} AS DOUBLE)" for f in features))
    return df.select(*keep, F.expr(stack).alias("feature", "value"))


def drift_ks(long_df: DataFrame, side: str = "is_test") -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature (I8).

    Rows are first pre-aggregated to (feature, value) counts per side, then the two
    empirical CDFs are exact running sums over the value order inside each feature,
    spread over quantile buckets (:func:`running_totals`).
    """
    counts = (long_df.filter(F.col("value").isNotNull())
              .groupBy("feature", "value")
              .agg(F.count_if(~F.col(side)).alias("c1"), F.count_if(F.col(side)).alias("c2")))
    run = running_totals(counts, ["feature"], "value", ["c1", "c2"])
    cdf = run.select("feature", F.try_divide("cum_c1", "tot_c1").alias("f1"),
                     F.try_divide("cum_c2", "tot_c2").alias("f2"))
    return cdf.groupBy("feature").agg(F.max(F.abs(F.col("f1") - F.col("f2"))).alias("ks"))


def drift_psi(long_df: DataFrame, side: str = "is_test", bins: int = 10,
              floor: float = 1e-4, approximate: bool = False) -> DataFrame:
    """Population stability index per feature over shared quantile bins: the bin edges
    are the reference (training) side's ``1/bins .. (bins-1)/bins`` quantiles, applied to
    both sides; empty shares are floored at ``floor``.

    The quantiles are exact: read at their ranks from running sums of value counts, spread
    over buckets, however many values a feature has. ``approximate`` asks for mergeable
    sketches instead (``percentile_approx``). A feature without rows on a side has NULL.
    """
    valued = long_df.filter(F.col("value").isNotNull())
    ref_side = valued.filter(~F.col(side))
    fracs = [i / bins for i in range(1, bins)]
    if approximate:
        edges = ref_side.groupBy("feature").agg(F.percentile_approx(F.col("value"), fracs, 10_000).alias("_q"))
    else:
        counts = ref_side.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
        run = running_totals(counts, ["feature"], "value", ["_c"])

        def at(f: float):                                # linear between the two ranks around f
            place = (F.col("tot__c") - 1) * F.lit(f)
            lo, hi = (F.min(F.when(F.col("cum__c") >= k + 1, F.col("value")))
                      for k in (F.floor(place), F.ceil(place)))
            share = F.max(place - F.floor(place))
            return lo + (hi - lo) * share

        edges = run.groupBy("feature").agg(F.array(*[at(f) for f in fracs]).alias("_q"))
    # one row per feature of a fixed feature list: a bounded broadcast
    j = valued.join(F.broadcast(edges), on="feature", how="inner")
    b = sum((F.when(F.col("value") > F.col("_q")[i], 1).otherwise(0) for i in range(bins - 1)),
            F.lit(0))
    per_bin = j.groupBy("feature", b.alias("bin")).agg(
        F.count_if(~F.col(side)).alias("c1"), F.count_if(F.col(side)).alias("c2"))
    tot = Window.partitionBy("feature")
    sides = [F.try_divide(F.col(c), F.sum(c).over(tot)) for c in ("c1", "c2")]
    e, a = (F.when(x.isNotNull(), F.greatest(x, F.lit(floor))) for x in sides)
    return (per_bin.select("feature", ((a - e) * F.log(a / e)).alias("_t"))
            .groupBy("feature").agg(F.sum("_t").alias("psi")))


def input_checks(df: DataFrame, rules: dict, keep=()) -> DataFrame:
    """Reject table for scoring inputs (F10): one row per (row, failed rule).

    ``rules`` maps a rule name to a Column condition that a valid row satisfies; a NULL
    condition counts as failed.
    """
    failed = F.filter(F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name))
                                for name, cond in rules.items()]), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(failed).alias("failed_rule"))
