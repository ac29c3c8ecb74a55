import math

import pytest

from wearcurve.operators.metrics import evaluate, select_model, stack_predictions


def scores(spark, pairs):
    df = spark.createDataFrame([(*p, "m", "val") for p in pairs], "RUL double, prediction double, model string, split string")
    return evaluate(df).first()


def test_values(spark):
    got = scores(spark, [(1.0, 2.0), (2.0, 2.0), (6.0, 3.0), (None, 1.0), (1.0, None)])
    assert got["n_rows"] == 3 and got["mae"] == pytest.approx(4 / 3)
    assert got["rmse"] == pytest.approx(math.sqrt(10 / 3)) and got["r2"] == pytest.approx(1 - 10 / 14)


def test_constant_target(spark):
    assert scores(spark, [(5.0, 5.0), (5.0, 5.0)])["r2"] == 1.0
    assert scores(spark, [(5.0, 5.0), (5.0, 6.0)])["r2"] == 0.0
    assert scores(spark, [(5.0, 5.0)])["r2"] is None


def test_two_models_in_one_pass_and_choice(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, "val"), (3, 3.0, 2.0, "val"), (3, 0.0, 3.0, "test")], "RUL int, a double, b double, split string")
    table = evaluate(stack_predictions(df, {"A": "a", "B": "b"}, keep=("split",)))
    got = {(r["model"], r["split"]): r["mae"] for r in table.collect()}
    assert got == {("A", "val"): 0.0, ("B", "val"): 0.5, ("A", "test"): 3.0, ("B", "test"): 0.0}
    assert select_model(table, ("B", "A")).first()["model"] == "A"


def test_ties_follow_the_preference(spark):
    table = spark.createDataFrame([("A", "val", 0.5), ("B", "val", 0.5), ("B", "test", 0.9)], "model string, split string, r2 double")
    assert select_model(table, ("B", "A")).first()["model"] == "B"
    assert select_model(table, ("A", "B")).first()["model"] == "A"
