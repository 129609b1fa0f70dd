import math

import pytest
from pyspark.sql import functions as F

from basketrank.operators import metrics
from basketrank.operators.predict import build_submission, top_per_customer


def ap(spark, actual, predicted, k=12):
    truth = spark.createDataFrame([("c", a) for a in actual], "customer_id string, article_id int").distinct()
    rows = spark.createDataFrame([("c", i + 1, a) for i, a in enumerate(predicted)], "customer_id string, rank int, article_id int")
    return metrics.average_precision(truth, rows, k).first().ap


@pytest.mark.parametrize("actual, predicted, expected", [
    ([1, 2], [1, 1, 2], (1 / 1 + 2 / 2 + 3 / 3) / 2),
    ([1, 2], [9, 1, 2], (1 / 2 + 2 / 3) / 2),
    (list(range(20)), list(range(12)), 1.0),
    ([1], [2, 3], 0.0),
    ([1], [2] * 12 + [1], 0.0),
])
def test_average_precision(spark, actual, predicted, expected):
    assert ap(spark, actual, predicted) == pytest.approx(expected)


def test_map_counts_customers_with_truth_and_prediction(spark, transactions):
    test_tx = transactions([("2020-09-17", "a", "0001", 1.0), ("2020-09-17", "a", "0001", 1.0), ("2020-09-17", "b", "0002", 1.0), ("2020-09-17", "x", "0002", 1.0)])
    submission = spark.createDataFrame([("a", "0009 0001"), ("b", "0002"), ("c", "0001")], "customer_id string, prediction string")
    row = metrics.evaluate_submission(test_tx, submission).first()
    assert row.n_customers == 2 and row.map_at_12 == pytest.approx((0.5 + 1.0) / 2)
    assert [tuple(r) for r in metrics.ground_truth(test_tx).orderBy("customer_id").collect()] == [("a", "0001", 1), ("b", "0002", 1), ("x", "0002", 1)]


def test_ndcg(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0, 3.0), ("a", 2, 1, 2.0), ("a", 3, 1, 1.0), ("b", 1, 0, 1.0)],
        "customer_id string, article_id int, label int, score double",
    )
    got = {r.customer_id: r.ndcg for r in metrics.ndcg(rows).collect()}
    expected = (1 / math.log2(3) + 1 / math.log2(4)) / (1 + 1 / math.log2(3))
    assert got == {"a": pytest.approx(expected)}


def test_submission(spark, transactions, customers, calendar):
    train = transactions([("2020-09-10", f"x{i}", f"{a:04d}", 1.0) for a in range(14) for i in range(20 - a)])
    scored = spark.createDataFrame(
        [("three", "0100", 0.5), ("three", "0101", 0.5), ("three", "0102", 0.9)] + [("many", f"{i:04d}", 1.0) for i in range(30)],
        "customer_id string, article_id string, score double",
    )
    known = customers([("three", 1.0), ("many", 1.0), ("none", 1.0)])
    lists = {r[0]: r[1].split(" ") for r in build_submission(scored, train, known, calendar).collect()}
    best = [f"{a:04d}" for a in range(12)]
    assert lists == {"three": ["0102", "0100", "0101"], "many": best, "none": best}
    padded = {r[0]: r[1].split(" ") for r in build_submission(scored, train, known, calendar, pad=True).collect()}
    assert padded["three"] == ["0102", "0100", "0101"] + best[:9]
    assert top_per_customer(scored, 2).where(F.col("customer_id") == "many").count() == 2
