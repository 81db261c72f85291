"""Fitted models through storage."""

import math

import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

from shelfspark.operators import scorers, split


def test_stored_logistic_model_scores_by_its_coefficients(spark, tmp_path):
    rows = [(float(i % 7), i % 5, str(i % 3), int(i % 7 + i % 5 > 5 or i % 11 == 0), "train" if i % 4 else "test") for i in range(200)]
    rows += [(None, 1, "1", 1, "train"), (1.0, 1, "2", None, "train")]
    df = spark.createDataFrame(rows, "a double, b int, c string, label int, data_split string")
    train = split.filter_train_rows(df)
    assert "data_split" not in train.columns and train.count() == 152
    scorers.fit_ml_model(train, LogisticRegression(), ["a", "b"]).write().overwrite().save(str(tmp_path / "model"))
    model = LogisticRegressionModel.load(str(tmp_path / "model"))
    got = scorers.score_ml_model(df.where("a IS NOT NULL"), model, ["a", "b"], "p").collect()
    for r in got:
        z = model.intercept + model.coefficients[0] * r.a + model.coefficients[1] * r.b
        assert r.p == pytest.approx(1 / (1 + math.exp(-z)))
    assert len(got) == 201 and got[0].__fields__ == [*df.columns, "p"]


def test_text_features_are_cast_in_fit_and_score(spark):
    df = spark.createDataFrame([(str(i), float(i), int(i > 5)) for i in range(12)], "a string, b double, label int")
    model = scorers.fit_ml_model(df, LogisticRegression(), ["a", "b"])
    got = scorers.score_ml_model(df, model, ["a", "b"], "p").collect()
    assert [r.p > 0.5 for r in got] == [i > 5 for i in range(12)]
