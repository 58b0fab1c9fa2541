"""Metrics, the score rule, the choice."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from latebird.operators import leaderboard, metrics


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(
        [(1, 2.0), (3, 3.0), (5, 1.0)], "ArrDelay int, prediction double"
    )


def _report(df):
    return {r["metric"]: r["value"] for r in metrics.evaluation_report(df).collect()}


def test_report(predictions):
    report = _report(predictions)
    assert report["RMSE"] == pytest.approx(2.380476, abs=1e-6)
    assert report["MAE"] == pytest.approx(1.666667, abs=1e-6)
    assert report["R2"] == pytest.approx(-1.125)


def test_report_leaves_out_unlabelled_rows(spark, predictions):
    more = predictions.union(spark.createDataFrame([(None, 7.0)], predictions.schema))
    assert _report(more) == _report(predictions)


def test_report_equals_the_evaluator(flights):
    df = flights.select(
        "ArrDelay", (F.col("DepDelay") + F.col("TaxiOut") - 11.0).alias("prediction")
    ).dropna()
    report = _report(df)
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="ArrDelay", metricName=name)
        assert report[name.upper()] == pytest.approx(evaluator.evaluate(df), rel=1e-12)


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0)], "ArrDelay int, prediction double")
    assert _report(df)["R2"] is None


def test_several_models_in_one_pass(predictions):
    df = predictions.withColumn("exact", F.col("ArrDelay").cast("double"))
    rows = metrics.compare_predictions(df, {"a": "prediction", "b": "exact"}).collect()
    assert [(r["order_no"], r["name"]) for r in rows] == [(0, "a"), (1, "b")]
    assert rows[0]["rmse"] == pytest.approx(2.380476, abs=1e-6)
    assert (rows[1]["rmse"], rows[1]["mae"], rows[1]["r2"]) == (0.0, 0.0, 1.0)


def _board(spark, *rows):
    return leaderboard.with_score(
        spark.createDataFrame(
            [(i, f"m{i}", float(a), float(b)) for i, (a, b) in enumerate(rows)],
            "order_no int, name string, rmse double, mae double",
        )
    )


def test_score_rule(spark):
    rows = _board(spark, (10, 4), (8, 4), (7, 4)).collect()
    assert [(r["metric"], r["score"]) for r in rows] == [("MAE", 4), ("RMSE", 8), ("RMSE", 7)]


def test_first_of_equals_wins(spark):
    assert leaderboard.best_model(_board(spark, (9, 8), (5, 4), (5, 4))).first()["name"] == "m1"
