"""Purchase statistics.

``pair_activity`` reads the purchases once and aggregates them to one row per
(customer, article). Every other statistic is an aggregate of that much smaller
table, so a customer or an article that holds a large part of all purchases is
already folded, on the map side, before anything is grouped by it alone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Calendar
from ..functions import after, age_group, days_until


def pair_activity(tx: DataFrame, calendar: Calendar, as_of: date) -> DataFrame:
    """All purchases of a (customer, article) pair, folded to one row."""
    in_season = F.col("t_dat").between(F.lit(calendar.season_start), F.lit(calendar.season_end))
    measures = [
        F.count(F.lit(1)).alias("n_all"),
        *_sum_and_count(F.col("price"), "all"),
        F.min("t_dat").alias("first_dat"),
        F.max("t_dat").alias("last_dat"),
        F.count_if(in_season).alias("n_season"),
        F.sum(F.pow(F.lit(calendar.decay_base), days_until(as_of, "t_dat").cast("double"))).alias("decay"),
    ]
    for suffix, days in calendar.windows.items():
        inside = after("t_dat", as_of, days)
        measures.append(F.count_if(inside).alias(f"n_{suffix}"))
        measures.extend(_sum_and_count(F.when(inside, F.col("price")), suffix))
    return tx.groupBy("customer_id", "article_id").agg(*measures)


def _sum_and_count(price: Column, suffix: str) -> list[Column]:
    """The two parts of a mean that can be added up again."""
    return [F.sum(price).alias(f"price_sum_{suffix}"), F.count(price).alias(f"price_n_{suffix}")]


def _mean_price(suffix: str) -> Column:
    prices = F.sum(f"price_n_{suffix}")
    return F.when(prices > 0, F.sum(f"price_sum_{suffix}") / prices)


def _when_positive(count: Column) -> Column:
    return F.when(count > 0, count)


# --- per customer -----------------------------------------------------------


def customer_activity(pairs: DataFrame, calendar: Calendar, as_of: date) -> DataFrame:
    """Counts, distinct articles and mean price per window; recency; mean price overall.

    A customer without a purchase in a window has nulls in its columns.
    """
    measures = []
    for suffix in calendar.windows:
        measures += [
            _when_positive(F.sum(f"n_{suffix}")).alias(f"n_purchases_{suffix}"),
            _when_positive(F.count_if(F.col(f"n_{suffix}") > 0)).alias(f"n_unique_articles_{suffix}"),
            _mean_price(suffix).alias(f"avg_price_{suffix}"),
        ]
    return pairs.groupBy("customer_id").agg(
        *measures,
        days_until(as_of, F.max("last_dat")).alias("days_since_last_purchase"),
        _mean_price("all").alias("cust_avg_price"),
    )


def age_median(customers: DataFrame) -> DataFrame:
    """Exact median of the known ages, as one row.

    Customers are folded to one row per distinct age first, so the list that
    is put in order is as long as there are ages, not customers.
    """
    by_age = customers.where(F.col("age").isNotNull()).groupBy("age").agg(F.count(F.lit(1)).alias("n"))
    return by_age.agg(F.percentile("age", 0.5, F.col("n")).alias("age_median"))


def customer_profile(customers: DataFrame) -> DataFrame:
    """Age with nulls set to the median, membership and newsletter flags, age group.

    An unknown membership stays null here; the feature table sets it to 0.
    """
    median = age_median(customers).scalar()
    filled = F.coalesce(F.col("age").cast("double"), median)
    return customers.select(
        "customer_id",
        filled.alias("age"),
        (F.col("club_member_status") == "ACTIVE").cast("tinyint").alias("is_club_member"),
        F.coalesce(F.col("fashion_news_frequency").isin("Regularly", "Monthly"), F.lit(False))
        .cast("tinyint")
        .alias("fashion_news_freq"),
    ).withColumn("age_group", age_group("age"))


# --- per article ------------------------------------------------------------


def article_activity(pairs: DataFrame, calendar: Calendar, as_of: date) -> DataFrame:
    """Popularity, recency, age, mean price, trend and seasonal sales of sold articles.

    Counts of windows without a sale are null, as in ``customer_activity``.
    """
    return pairs.groupBy("article_id").agg(
        _when_positive(F.sum("n_7d")).alias("article_popularity_7d"),
        _when_positive(F.sum("n_14d")).alias("article_popularity_14d"),
        days_until(as_of, F.max("last_dat")).alias("days_since_article_last_sold"),
        days_until(as_of, F.min("first_dat")).alias("article_age_days"),
        _mean_price("all").alias("art_avg_price"),
        (F.sum("n_7d") / (F.sum("n_all") + F.lit(1))).alias("sales_trend"),
        _when_positive(F.sum("n_season")).alias("autumn_2019_sales"),
    )


def article_attributes(articles: DataFrame) -> DataFrame:
    return articles.select(
        "article_id", "product_type_no", "colour_group_code", "department_no", "perceived_colour_value_id"
    )


def age_article_popularity(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """Purchases in the 14-day window per (age group, article).

    Buyers missing from the customers table form a group of their own (null).
    """
    recent = pairs.where(F.col("n_14d") > 0).select("customer_id", "article_id", "n_14d")
    return (
        recent.join(profile.select("customer_id", "age_group"), "customer_id", "left")
        .groupBy("age_group", "article_id")
        .agg(F.sum("n_14d").alias("article_popularity_age_group_14d"))
    )


# --- per pair, customer x product type, customer x department ---------------


def pair_features(pairs: DataFrame) -> DataFrame:
    """Decay weight, purchase count and the bought-before flag of each bought pair."""
    return pairs.select(
        "customer_id",
        "article_id",
        F.col("decay").alias("user_item_decay_weight"),
        F.col("n_all").alias("user_item_purchase_count"),
        F.lit(1).cast("tinyint").alias("user_has_bought_before"),
    )


def user_product_types(pairs: DataFrame, articles: DataFrame) -> DataFrame:
    return _distinct_attribute(pairs, articles, "product_type_no")


def user_departments(pairs: DataFrame, articles: DataFrame) -> DataFrame:
    return _distinct_attribute(pairs, articles, "department_no")


def _distinct_attribute(pairs: DataFrame, articles: DataFrame, column: str) -> DataFrame:
    bought = pairs.select("customer_id", "article_id")
    return (
        bought.join(articles.select("article_id", column), "article_id", "left")
        .select("customer_id", column)
        .distinct()
    )


def department_affinity(pairs: DataFrame, articles: DataFrame) -> DataFrame:
    """Share of each department in a customer's purchases."""
    totals = pairs.groupBy("customer_id").agg(F.sum("n_all").alias("total"))
    per_department = (
        pairs.select("customer_id", "article_id", "n_all")
        .join(articles.select("article_id", "department_no"), "article_id", "left")
        .groupBy("customer_id", "department_no")
        .agg(F.sum("n_all").alias("bought"))
    )
    return per_department.join(totals, "customer_id").select(
        "customer_id", "department_no", (F.col("bought") / F.col("total")).alias("user_dept_affinity")
    )
