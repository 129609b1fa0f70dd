"""Ranking metrics: truth sets, AP@k, MAP@k, NDCG@k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ap_weight, discount


def truth_pairs(test_tx: DataFrame) -> DataFrame:
    """Distinct (customer, article) bought in the test period."""
    return test_tx.select("customer_id", "article_id").distinct()


def ground_truth(test_tx: DataFrame) -> DataFrame:
    """The articles of each customer in the test period, one row each, and how many there are.

    A set per customer is kept as rows: it may hold the whole catalogue.
    """
    truth = truth_pairs(test_tx)
    sizes = truth.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_bought"))
    return truth.join(sizes, "customer_id")


def predicted_rows(submission: DataFrame, k: int = 12) -> DataFrame:
    """A submission's space-joined ids as rows (customer_id, rank, article_id), rank from 1."""
    first = F.slice(F.split("prediction", " "), 1, k)
    return submission.select("customer_id", F.posexplode(first).alias("pos", "article_id")).select(
        "customer_id", (F.col("pos") + 1).alias("rank"), "article_id"
    )


def average_precision(truth: DataFrame, predicted: DataFrame, k: int = 12, by: str | None = None) -> DataFrame:
    """AP@k of each customer with a truth and a prediction.

    ``truth`` holds distinct (customer_id, article_id), ``predicted`` rows of
    (customer_id, rank, article_id). A repeated prediction counts again. With
    ``by``, an extra column of ``predicted``, each of its values is a ranking
    of its own. No window holds more than k rows.
    """
    keys = ["customer_id", *([by] if by else [])]
    actual = truth.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_actual"))
    marked = (
        predicted.where(F.col("rank") <= k)
        .withColumn("article_id", F.col("article_id").cast(truth.schema["article_id"].dataType))
        .join(truth.withColumn("hit", F.lit(1)), ["customer_id", "article_id"], "left")
    )
    so_far = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gains = marked.withColumn("hits", F.sum("hit").over(so_far)).groupBy(*keys).agg(
        F.sum(F.when(F.col("hit") == 1, ap_weight("hits", "rank")).otherwise(F.lit(0.0))).alias("gain")
    )
    return gains.join(actual, "customer_id").select(
        *keys, (F.col("gain") / F.least("n_actual", F.lit(k))).alias("ap")
    )


def mean_average_precision(truth: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    """MAP@k as one row."""
    return average_precision(truth, predicted, k).agg(
        F.avg("ap").alias(f"map_at_{k}"), F.count(F.lit(1)).alias("n_customers")
    )


def evaluate_submission(test_tx: DataFrame, submission: DataFrame, k: int = 12) -> DataFrame:
    """MAP@k of a submission against the purchases of the test period."""
    return mean_average_precision(truth_pairs(test_tx), predicted_rows(submission, k), k)


def ideal_dcg(positives, k: int = 12):
    """DCG of ``positives`` hits at the top, cut at k."""
    steps = [F.lit(0.0)]
    for rank in range(1, k + 1):
        steps.append(steps[-1] + discount(F.lit(rank)))
    return F.element_at(F.array(*steps), (F.least(positives, F.lit(k)) + 1).cast("int"))


def ndcg(scored: DataFrame, k: int = 12) -> DataFrame:
    """NDCG@k of each customer with a positive, from rows (customer_id, article_id, label, score)."""
    best = Window.partitionBy("customer_id").orderBy(F.desc("score"), "article_id")
    top = scored.select("customer_id", "article_id", "label", "score").withColumn(
        "rank", F.row_number().over(best)
    ).where(F.col("rank") <= k)
    dcg = top.groupBy("customer_id").agg(F.sum(F.col("label") * discount("rank")).alias("dcg"))
    positives = scored.where(F.col("label") == 1).groupBy("customer_id").agg(F.count(F.lit(1)).alias("positives"))
    return positives.join(dcg, "customer_id").select(
        "customer_id", (F.col("dcg") / ideal_dcg(F.col("positives"), k)).alias("ndcg")
    )
