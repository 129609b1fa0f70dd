"""Image files named after article ids, in folders named by the first three characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, images_dir: str) -> DataFrame:
    """(article_id, content) of every ``<first 3 characters>/<article_id>.jpg``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", True).load(images_dir)
    parts = F.split("path", "/")
    named = files.select(
        F.regexp_replace(F.element_at(parts, -1), r"\.jpg$", "").alias("article_id"),
        F.element_at(parts, -2).alias("folder"),
        "content",
    )
    return named.where(F.col("folder") == F.substring("article_id", 1, 3)).drop("folder")


def without_image(articles: DataFrame, images: DataFrame) -> DataFrame:
    """Articles that have no file."""
    return articles.select("article_id").distinct().join(images.select("article_id"), "article_id", "left_anti")
