"""Look-ups for a demo page: recommendations, history, subset export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import image_path, pad_id
from .metrics import predicted_rows

UNKNOWN = "Unknown Product"


def recommendation_lookup(submission: DataFrame, articles: DataFrame, k: int = 12) -> DataFrame:
    """A submission as rows with padded id, product name and image path."""
    rows = predicted_rows(submission, k).withColumn("article_id", pad_id("article_id"))
    names = articles.select(pad_id("article_id").alias("article_id"), "prod_name")
    return rows.join(names, "article_id", "left").select(
        "customer_id", "rank", "article_id",
        F.coalesce("prod_name", F.lit(UNKNOWN)).alias("prod_name"),
        image_path("article_id").alias("image_path"),
    )


def recent_purchases(tx: DataFrame, articles: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` purchases of each customer, newest first, with product names."""
    newest = Window.partitionBy("customer_id").orderBy(F.desc("t_dat"), "article_id", "price")
    last = tx.select("customer_id", "t_dat", "article_id", "price").withColumn(
        "rank", F.row_number().over(newest)
    ).where(F.col("rank") <= n)
    return last.join(articles.select("article_id", "prod_name"), "article_id", "left").select(
        "customer_id", "rank", "t_dat", "article_id", "prod_name", image_path("article_id").alias("image_path")
    )


def only_customers(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen customers; the list may be any size."""
    return df.join(chosen.select("customer_id"), "customer_id", "left_semi")
