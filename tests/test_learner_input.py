"""Learners share their cached input over tasks (train_classify, train_regress)."""

import pytest
from pyspark.sql import functions as F

from aerolytics.plans import ml_queries


@pytest.mark.parametrize("query, learner", [("q_train_classify", "train_classifiers"), ("q_train_regress", "train_regressors")])
def test_input_of_tree_learners_is_cut_by_rows(spark, monkeypatch, query, learner):
    data = spark.range(0, 4000, 1, 8).select(F.col("id").cast("double").alias("pm25_lag1"), F.lit(1.0).alias("pm25"),
                                             F.lit(0).alias("aqi_label"), (F.col("id") % 5 == 0).alias("is_test"))
    seen = []
    monkeypatch.setattr(ml_queries, "TREE_ROWS", 1000, raising=False)
    monkeypatch.setattr(ml_queries, "_split_features", lambda spark, sf_dir: data)
    monkeypatch.setattr(ml_queries.models, learner, lambda train, test, *a, **k: (None, seen.extend((train, test))))
    getattr(ml_queries, query)(spark, "")
    assert [d.rdd.getNumPartitions() for d in seen] == [4, 4]
    assert [d.count() for d in seen] == [3200, 800]
