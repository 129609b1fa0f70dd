"""Stage 1: candidate articles per customer."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SOURCES, Calendar
from ..functions import after, age_group

PAIR = ["customer_id", "article_id"]


def _tagged(pairs: DataFrame, source: str) -> DataFrame:
    return pairs.select(*PAIR, F.lit(source).alias("source"))


def recent_activity(train_tx: DataFrame, calendar: Calendar, as_of: date | None = None) -> DataFrame:
    """Purchases of the last 90 days, one row per pair, with counts for 90, 14 and 7 days.

    The windows look back from the last training day unless ``as_of`` is given.

    All generators start from this table: the purchases are read and shuffled
    once, and a customer or article with very many of them is already folded.
    """
    as_of = as_of or calendar.last_train
    counted = {"n_14d": calendar.fortnight, "n_7d": calendar.week}
    return (
        train_tx.where(after("t_dat", as_of, calendar.quarter))
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("n_90d"),
            *[F.count_if(after("t_dat", as_of, days)).alias(n) for n, days in counted.items()],
        )
    )


def repurchase(recent: DataFrame) -> DataFrame:
    """Articles a customer bought in the last 14 days."""
    return _tagged(recent.where(F.col("n_14d") > 0), "repurchase")


def popular_by_age(recent: DataFrame, customers: DataFrame, top: int = 100) -> DataFrame:
    """The most bought articles of the last 14 days in each age group, ties to the lower id."""
    grouped = (
        recent.where(F.col("n_14d") > 0)
        .join(customers.select("customer_id", age_group("age").alias("age_group")), "customer_id")
        .groupBy("age_group", "article_id")
        .agg(F.sum("n_14d").alias("n"))
    )
    best = Window.partitionBy("age_group").orderBy(F.desc("n"), "article_id")
    return grouped.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def warm_customers(recent: DataFrame, customers: DataFrame) -> DataFrame:
    """Known customers who bought in the last 90 days, but not in the last 14."""
    idle = recent.groupBy("customer_id").agg(F.sum("n_14d").alias("n")).where(F.col("n") == 0)
    return customers.join(idle.select("customer_id"), "customer_id", "left_semi")


def age_popular(recent: DataFrame, customers: DataFrame, top: int = 100) -> DataFrame:
    """The popular articles of their age group for warm customers."""
    warm = warm_customers(recent, customers).select("customer_id", age_group("age").alias("age_group"))
    popular = popular_by_age(recent, customers, top).select("age_group", "article_id")
    # At most `top` rows for each of the four age groups.
    return _tagged(warm.join(F.broadcast(popular), "age_group"), "age_popular")


def global_popular(recent: DataFrame, customers: DataFrame, top: int = 100) -> DataFrame:
    """The most bought articles of the last 7 days for customers idle for 90 days."""
    idle = customers.select("customer_id").join(
        recent.select("customer_id").distinct(), "customer_id", "left_anti"
    )
    sold = recent.where(F.col("n_7d") > 0).groupBy("article_id").agg(F.sum("n_7d").alias("n"))
    listed = best_articles(sold, top).agg(F.sort_array(F.collect_list("article_id")).alias("articles"))
    return _tagged(idle.select("customer_id", F.explode(listed.scalar()).alias("article_id")), "global_popular")


def best_articles(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of (article_id, n) with their rank, ties to the lower id."""
    best = counts.orderBy(F.desc("n"), "article_id").limit(top)
    # Only `top` rows are left, so ranking them needs no partitions.
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "article_id")))


def merge_candidates(
    sources: Iterable[DataFrame], customers: DataFrame, known: Iterable[DataFrame] = (), distinct: bool = True
) -> DataFrame:
    """Union of the sources for known customers, each (customer, article, source) once.

    Sources in ``known`` were made from the customers table and skip the check.
    One shuffle by pair serves both the de-duplication here and a following
    ``source_pivot``, which needs none (``distinct=False``); pairs spread a heavy
    customer over all partitions.
    """
    cols = [*PAIR, "source"]
    parts = [
        source.select(*cols).join(customers.select("customer_id"), "customer_id", "left_semi") for source in sources
    ] + [source.select(*cols) for source in known]
    merged = reduce(DataFrame.unionByName, parts)
    return merged.repartition(*PAIR).dropDuplicates(cols) if distinct else merged


def source_pivot(candidates: DataFrame) -> DataFrame:
    """One row per pair with a 0/1 flag for every source, generated or not."""
    flags = [
        F.max((F.col("source") == name).cast("tinyint")).alias(f"candidate_source_{name}")
        for name in SOURCES
    ]
    return candidates.groupBy(*PAIR).agg(*flags)


def generate_candidates(
    recent: DataFrame, customers: DataFrame, als: DataFrame | None = None, extra: Iterable[DataFrame] = (),
    distinct: bool = True,
) -> DataFrame:
    """All sources merged; ``als`` and ``extra`` are candidates made beforehand."""
    made = [repurchase(recent), *([als] if als is not None else []), *extra]
    return merge_candidates(made, customers, known=[age_popular(recent, customers)], distinct=distinct)
