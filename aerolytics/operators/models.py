"""Supervised learning and scoring with Spark ML.

Each learner is a ``Pipeline([VectorAssembler, StandardScaler, estimator])`` fitted on the
training split only, so the scaler never sees test rows. Metrics come from the aggregate
evaluators in :mod:`aerolytics.operators.evaluate` and are returned as ``model_runs``
rows; the best model is chosen by a query on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.constants import AQI_CATEGORIES, SEED
from aerolytics.functions.aqi import aqi_category, code_to_category
from aerolytics.functions.scalar import nonneg
from aerolytics.operators import evaluate
from aerolytics.operators.clean import available, pad_features
from aerolytics.operators.stages import PadStage
from aerolytics.sources import files


def model_input(df: DataFrame, wanted, label: str, keep=()) -> tuple[DataFrame, list[str]]:
    """Schema-tolerant feature table: the wanted columns that exist, NULL -> 0, plus label."""
    feats = available(df, wanted)
    out = pad_features(df, feats, keep=[*keep, label])
    return out, feats


def make_pipeline(features: list[str], estimator, scale: bool = True) -> Pipeline:
    """Assemble the feature columns (inputs are padded, so there are no NULLs), standardise
    with the statistics of the data the pipeline is fitted on, then the estimator."""
    stages = [VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True,
                                     withStd=True))
    else:
        stages[0].setOutputCol("features")
    return Pipeline(stages=[*stages, estimator])


@dataclass
class Fitted:
    name: str
    order: int
    model: PipelineModel


# --- classification -----------------------------------------------------------------

def classifiers(label: str, rf_trees: int = 200, rf_depth: int = 12, gbt_rounds: int = 300,
                gbt_depth: int = 8, gbt_lr: float = 0.05):
    """Random forest, and multiclass boosted trees as one-vs-rest over binary GBTs
    (MLlib GBT is binary only), whose classes are fitted side by side."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=rf_trees,
                                maxDepth=rf_depth, seed=SEED)
    gbt = OneVsRest(labelCol=label, featuresCol="features", parallelism=len(AQI_CATEGORIES), classifier=GBTClassifier(
        maxIter=gbt_rounds, maxDepth=gbt_depth, stepSize=gbt_lr, seed=SEED))
    return [("random_forest", rf), ("boosted_trees", gbt)]


def train_classifiers(train: DataFrame, test: DataFrame, features, label: str = "aqi_label",
                      **params) -> tuple[list[Fitted], DataFrame]:
    """Fit every classifier on ``train``; return fitted models and ``model_runs`` rows."""
    fitted, runs = [], None
    for order, (name, est) in enumerate(classifiers(label, **params), start=1):
        model = make_pipeline(features, est).fit(train)
        pred = model.transform(test).select(F.col(label).cast("int").alias("y"),
                                            F.col("prediction").cast("int").alias("p"))
        m = evaluate.classification_metrics(pred).select(
            F.lit(name).alias("model"), F.lit(order).alias("trained_order"), "accuracy", "f1_macro")
        r = evaluate.metrics_to_runs(m, "classification")
        runs = r if runs is None else runs.unionByName(r)
        fitted.append(Fitted(name, order, model))
    return fitted, runs


# --- regression ---------------------------------------------------------------------

def ridge_reg_param(train: DataFrame, label: str, alpha: float = 1.0) -> float:
    """MLlib penalty equal to sklearn ``Ridge(alpha)``: ``alpha * stddev_pop(y) / n``."""
    row = train.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return float(alpha * row["s"] / row["n"]) if row["n"] else 0.0


def regressors(label: str, reg_param: float, gbt_rounds: int = 300, gbt_depth: int = 5,
               gbt_lr: float = 0.05, rf_trees: int = 200, rf_depth: int = 12):
    return [
        ("gradient_boosting", GBTRegressor(labelCol=label, featuresCol="features",
                                           maxIter=gbt_rounds, maxDepth=gbt_depth,
                                           stepSize=gbt_lr, seed=SEED)),
        ("random_forest", RandomForestRegressor(labelCol=label, featuresCol="features",
                                                numTrees=rf_trees, maxDepth=rf_depth,
                                                featureSubsetStrategy="all", seed=SEED)),
        ("ridge", LinearRegression(labelCol=label, featuresCol="features", elasticNetParam=0.0,
                                   regParam=reg_param, standardization=False, solver="normal")),
    ]


def train_regressors(train: DataFrame, test: DataFrame, features, label: str = "pm25",
                     alpha: float = 1.0, **params) -> tuple[list[Fitted], DataFrame]:
    reg_param = ridge_reg_param(train, label, alpha)
    fitted, runs = [], None
    for order, (name, est) in enumerate(regressors(label, reg_param, **params), start=1):
        model = make_pipeline(features, est).fit(train)
        pred = model.transform(test).select(F.col(label).alias("y"), F.col("prediction").alias("p"))
        m = evaluate.regression_metrics(pred).select(
            F.lit(name).alias("model"), F.lit(order).alias("trained_order"), "rmse", "mae", "r2")
        r = evaluate.metrics_to_runs(m, "regression")
        runs = r if runs is None else runs.unionByName(r)
        fitted.append(Fitted(name, order, model))
    return fitted, runs


# --- scoring ------------------------------------------------------------------------

def score_regression(model: PipelineModel, df: DataFrame, features, keep=()) -> DataFrame:
    """Batch scoring (H18): pad absent features with 0 in model order, predict, clamp at 0,
    round to 2 places, derive the category from the unclamped value. No shuffle."""
    padded = pad_features(df, features, keep=keep)
    pred = model.transform(padded)
    return pred.select(*keep, F.round(nonneg(F.col("prediction")), 2).alias("pm25_prediction"),
                       aqi_category(F.col("prediction")).alias("aqi_category"))


def score_classification(model: PipelineModel, df: DataFrame, features, keep=()) -> DataFrame:
    """Label, text and confidence (top class probability, 3 places).

    One-vs-rest models have no probability column, so their raw per-class scores go
    through a softmax.
    """
    # absent calendar cosines count as 1 (the angle 0), other features as 0
    padded = PadStage(features=features).transform(df).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *features])])
    pred = model.transform(padded)
    if "probability" in pred.columns:
        conf = F.array_max(vector_to_array(F.col("probability")))
    else:
        raw = vector_to_array(F.col("rawPrediction"))
        mx = F.array_max(raw)
        exps = F.transform(raw, lambda v: F.exp(v - mx))
        conf = F.lit(1.0) / F.aggregate(exps, F.lit(0.0), lambda acc, v: acc + v)
    return pred.select(*keep, F.col("prediction").cast("int").alias("aqi_label"),
                       code_to_category(F.col("prediction")).alias("aqi_category"),
                       F.round(conf, 3).alias("confidence"))


def full_pipeline(model: PipelineModel, features, *stages) -> PipelineModel:
    """The artifact to save: raw-column stages, the feature list, then the fitted model."""
    return PipelineModel(stages=[*stages, PadStage(features=list(features)), *model.stages])


def pipeline_inputs(model: PipelineModel) -> tuple[list[str], list[str]]:
    """(features, text columns) that a saved pipeline reads."""
    features: list[str] = []
    text: list[str] = []
    for stage in model.stages:
        if isinstance(stage, PadStage):
            features += stage.getOrDefault(stage.features)
        elif hasattr(stage, "inputs"):
            text += stage.inputs()
    return features, text


def score_csv(spark, path, model_path: str, keep=("row_index",)) -> DataFrame:
    """An uploaded CSV to predictions: the stored pipeline says which columns are read, codes,
    calendar, padding and scaling are those of training; predictions and category as in
    :func:`score_regression`, with the index of the row in the file."""
    model = load_model(model_path)
    if model is None:
        raise FileNotFoundError(f"no model at {model_path}")
    features, text = pipeline_inputs(model)
    batch = files.read_batch_csv(spark, path, features, text)
    pred = model.transform(batch)
    return pred.select(*keep, F.round(nonneg(F.col("prediction")), 2).alias("pm25_prediction"),
                       aqi_category(F.col("prediction")).alias("aqi_category"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """A missing artifact is tolerated: ``None`` instead of an error. An unreadable one is not."""
    if not files.exists(path):
        return None
    return PipelineModel.load(path)
