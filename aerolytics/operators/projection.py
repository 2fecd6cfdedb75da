"""Principal components (H12, H13): distributed covariance, tiny eigen-problem on the driver.

The d x d covariance of the standardised features is one aggregate (``covar_samp`` per
pair); the eigen-decomposition of that small matrix runs on the driver; the projection
is a plain ``select`` of dot products, so scoring stays inside whole-stage codegen.
Component signs are fixed (largest absolute loading positive) so projections repeat.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.constants import PCA_VARIANCE_TARGET
from aerolytics.operators.clean import scale_standard


def covariance(df: DataFrame, cols) -> DataFrame:
    """Sample covariance of every pair (a <= b): feature_a, feature_b, covariance."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    stack = "stack({}, {})".format(len(pairs), ", ".join(
        f"'{a}', '{b}', _c{i}" for i, (a, b) in enumerate(pairs)))
    return row.select(F.expr(stack).alias("feature_a", "feature_b", "covariance"))


def fit_pca(df: DataFrame, cols, variance: float = PCA_VARIANCE_TARGET):
    """Standardise (population std), then eigen-decompose the covariance.

    Returns (components d x d with fixed signs, explained variance ratios, number of
    components reaching ``variance``).
    """
    cols = list(cols)
    cov_rows = covariance(df, cols).collect()  # d(d+1)/2 numbers
    idx = {c: i for i, c in enumerate(cols)}
    m = np.zeros((len(cols), len(cols)))
    for r in cov_rows:
        i, j = idx[r["feature_a"]], idx[r["feature_b"]]
        m[i, j] = m[j, i] = r["covariance"] or 0.0
    vals, vecs = np.linalg.eigh(m)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0, None), vecs[:, order]
    for k in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, k])), k] < 0:
            vecs[:, k] = -vecs[:, k]
    ratio = vals / vals.sum() if vals.sum() > 0 else vals
    n_comp = int(np.searchsorted(np.cumsum(ratio), variance, side="right") + 1)
    return vecs, ratio, min(n_comp, len(cols))


def project(df: DataFrame, cols, components, n: int = 2, names=("pca_x", "pca_y"), keep=()):
    """Dot products with the first ``n`` components (built-in expressions only)."""
    outs = []
    for k in range(n):
        expr = sum((F.col(c) * F.lit(float(components[i, k])) for i, c in enumerate(cols)),
                   F.lit(0.0))
        outs.append(expr.alias(names[k]))
    return df.select(*keep, *outs)


def pca_projection(df: DataFrame, cols, keep=(), variance: float = PCA_VARIANCE_TARGET):
    """Complete rows only, standardise, fit, project to two dimensions."""
    complete = df.na.drop(how="any", subset=list(cols))
    scaled = scale_standard(complete, list(cols))
    comps, ratio, n_comp = fit_pca(scaled, list(cols), variance)
    return project(scaled, list(cols), comps, 2, keep=keep), ratio, n_comp


def variance_table(spark, ratio, n_comp: int):
    """Explained variance per component (from the d x d eigen-problem): component,
    ratio, cumulative ratio, kept (within the first ``n_comp``)."""
    import numpy as _np
    cum = _np.cumsum(ratio)
    rows = [(i + 1, float(r), float(c), i < n_comp) for i, (r, c) in enumerate(zip(ratio, cum))]
    return spark.createDataFrame(rows, "component int, variance_ratio double, cumulative double, kept boolean")
