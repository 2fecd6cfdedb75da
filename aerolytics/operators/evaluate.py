"""Model evaluation as aggregates.

Metrics are one partial + final aggregate over (truth, prediction) columns; the confusion
matrix is a grouped count with at most classes x classes rows, and macro F1 is computed
from it. Model comparison runs on a ``model_runs`` table (task, model, trained_order,
metric, value), so choosing, gating and reporting are plain DataFrame queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.constants import GATE_MAX_RMSE, GATE_MIN_ACCURACY
from aerolytics.functions.scalar import one_row

MODEL_RUNS_SCHEMA = "task string, model string, trained_order int, metric string, value double"

# Which metric picks the best model of a task, and in which direction.
HIGHER_IS_BETTER = {"f1_macro": True, "accuracy": True, "silhouette": True, "r2": True,
                    "rmse": False, "mae": False}


def regression_metrics(df: DataFrame, truth: str = "y", pred: str = "p", by=()) -> DataFrame:
    """RMSE, MAE and R^2 (``1 - SSE / (n * var_pop(y))``) in one aggregate.

    Only rows with both values count. With a constant truth R^2 is 1 for exact predictions
    and 0 otherwise; without a complete row all three are NULL.
    """
    e = F.col(pred) - F.col(truth)
    n = F.count(e)
    sse = F.sum(e * e)
    spread = n * F.var_pop(F.when(F.col(pred).isNotNull(), F.col(truth)))
    aggs = [F.sqrt(F.try_divide(sse, n)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            F.when(spread > 0, F.lit(1.0) - F.try_divide(sse, spread))
            .when(sse == 0, F.lit(1.0)).when(sse > 0, F.lit(0.0)).alias("r2")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def confusion_matrix(df: DataFrame, truth: str = "y", pred: str = "p", by=()) -> DataFrame:
    return (df.groupBy(*by, F.col(truth).alias("label"), F.col(pred).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def classification_metrics(df: DataFrame, truth: str = "y", pred: str = "p", by=()) -> DataFrame:
    """Accuracy and macro F1 over the union of true and predicted classes (0 on 0/0)."""
    by = list(by)
    conf = confusion_matrix(df, truth, pred, by)
    # every confusion cell counts once for its true class and once for its predicted
    # class: per class true positives (tp), true support (st), predicted support (sp);
    # the classes are the union of both sides
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    sides = F.explode(F.array(
        F.struct(F.col("label").alias("c"), hit.alias("tp"), F.col("count").alias("st"),
                 F.lit(0).cast("long").alias("sp")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("st"), F.col("count").alias("sp"))))
    per = (conf.select(*by, sides.alias("e")).select(*by, "e.*")
           .groupBy(*by, "c").agg(F.sum("tp").alias("tp"), F.sum("st").alias("st"),
                                  F.sum("sp").alias("sp")))
    f1 = F.when(F.col("st") + F.col("sp") == 0, F.lit(0.0)) \
        .otherwise(2.0 * F.col("tp") / (F.col("st") + F.col("sp")))
    aggs = [F.try_divide(F.sum("tp"), F.sum("st")).alias("accuracy"), F.avg(f1).alias("f1_macro")]
    return per.groupBy(*by).agg(*aggs) if by else per.agg(*aggs)


def metrics_to_runs(metrics: DataFrame, task: str, model_col: str = "model",
                    order_col: str = "trained_order") -> DataFrame:
    """Wide metrics (one row per model) -> long ``model_runs`` rows."""
    names = [c for c in metrics.columns if c not in (model_col, order_col)]
    stack = F.expr("stack({}, {})".format(
        len(names), ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)))
    return metrics.select(F.lit(task).alias("task"), F.col(model_col).alias("model"),
                          F.col(order_col).cast("int").alias("trained_order"),
                          stack.alias("metric", "value"))


def best_model(runs: DataFrame, choice: dict[str, str]) -> DataFrame:
    """Per task, the model with the best value of ``choice[task]``; ties -> first trained."""
    picked = F.lit(False)
    for task, metric in choice.items():
        picked = picked | ((F.col("task") == task) & (F.col("metric") == metric))
    higher = [m for m, up in HIGHER_IS_BETTER.items() if up]
    score = F.when(F.col("metric").isin(higher), F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("task").orderBy(F.col("_score").desc(), F.col("trained_order"))
    return (runs.filter(picked).withColumn("_score", score)
            .withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1)
            .select("task", "model", "metric", "value"))


def model_gate(runs: DataFrame, max_rmse: float = GATE_MAX_RMSE,
               min_accuracy: float = GATE_MIN_ACCURACY) -> DataFrame:
    """Quality gates: RMSE below ``max_rmse``, accuracy above ``min_accuracy``."""
    gated = runs.filter(F.col("metric").isin("rmse", "accuracy"))
    passed = F.when(F.col("metric") == "rmse", F.col("value") < max_rmse) \
        .otherwise(F.col("value") > min_accuracy)
    return gated.select("task", "model", "metric", "value", passed.alias("passed"))


def experiment_report(runs: DataFrame, choice: dict[str, str]) -> DataFrame:
    """Flattened runs with a title-cased task name and the best-model flag."""
    best = best_model(runs, choice).select("task", F.col("model").alias("_best"))
    return (runs.join(best, on="task", how="left")
            .select(F.initcap(F.regexp_replace("task", "_", " ")).alias("task_title"),
                    "model", "metric", "value",
                    F.coalesce(F.col("model") == F.col("_best"), F.lit(False)).alias("is_best")))


def moments(df: DataFrame, x: str = "residual") -> DataFrame:
    """Mean, sample std, population skewness and excess kurtosis, written out from central
    moments (engines disagree on the built-in corrections)."""
    n = F.count(F.col(x)).cast("double")
    base = df.agg(n.alias("_n"), F.avg(F.col(x)).alias("_mu"))
    mu = one_row(base)["_mu"]
    d = F.col(x) - mu
    m = df.agg(F.count(F.col(x)).cast("double").alias("n"), F.avg(F.col(x)).alias("mean"),
               F.avg(d * d).alias("m2"), F.avg(d * d * d).alias("m3"), F.avg(d * d * d * d).alias("m4"))
    return m.select(
        F.col("n").cast("long").alias("n"), "mean",
        F.sqrt(F.try_divide(F.col("m2") * F.col("n"), F.col("n") - 1)).alias("std"),
        # NULL where all values are equal
        F.try_divide(F.col("m3"), F.pow(F.col("m2"), F.lit(1.5))).alias("skewness"),
        (F.try_divide(F.col("m4"), F.col("m2") * F.col("m2")) - 3).alias("kurtosis"))


def histogram(df: DataFrame, x: str = "residual", bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max: bin, lower edge, upper edge, count."""
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    s = one_row(rng)
    j = df.select(x).filter(F.col(x).isNotNull()).select(x, s["_lo"].alias("_lo"), s["_hi"].alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(x) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return (j.groupBy(b.alias("bin"), F.col("_lo"), F.col("_hi")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins)
                    .alias("lower"),
                    (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins)
                    .alias("upper"), "count"))
