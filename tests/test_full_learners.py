"""The registered classifiers are those of the reference: 200 trees of depth 12, 300 rounds of depth 8."""

from pyspark.sql import functions as F

from aerolytics.operators import models
from aerolytics.plans import ml_queries


def test_train_classify_runs_at_full_settings(spark, monkeypatch):
    data = spark.range(0, 40, 1, 2).select(F.col("id").cast("double").alias("pm25_lag1"), F.lit(1.0).alias("pm25"),
                                           (F.col("id") % 3).alias("aqi_label"), (F.col("id") % 5 == 0).alias("is_test"))
    seen = []

    class Fitted:
        def transform(self, df):
            return df.withColumn("prediction", F.col("aqi_label").cast("double"))

    class Pipe:
        def fit(self, df):
            return Fitted()

    monkeypatch.setattr(ml_queries, "_split_features", lambda spark, sf_dir: data)
    monkeypatch.setattr(models, "make_pipeline", lambda features, est: seen.append(est) or Pipe())
    runs = ml_queries.q_train_classify(spark, "")
    assert {r["model"] for r in runs.collect()} == {"random_forest", "boosted_trees"}
    forest, boosted = seen
    trees = boosted.getClassifier()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSubsamplingRate()) == (200, 12, 1.0)
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), trees.getSubsamplingRate()) == (300, 8, 0.05, 1.0)


def test_classes_fitted_side_by_side_give_the_same_model(spark):
    rows = spark.range(0, 240, 1, 2).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                            F.when(F.col("id") % 17 > 9, 2).when(F.col("id") % 5 > 2, 1).otherwise(0).alias("y"))
    est = models.classifiers("y", gbt_rounds=2, gbt_depth=2)[1][1]
    said = []
    for threads in (1, est.getParallelism()):
        model = models.make_pipeline(["a", "b"], est.copy().setParallelism(threads)).fit(rows)
        said.append([m.toDebugString.split("\n", 1)[1] for m in model.stages[-1].models])
    assert said[0] == said[1] and len(said[0]) == 3
