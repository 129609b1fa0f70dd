"""The recommender's input tables as views of the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TESTDATA
from ..session import tune
from ..sources import Inputs


def bind(spark: SparkSession, sf_dir: str) -> Inputs:
    tune(spark)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines = table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    transactions = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("t_dat"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
    )
    segment = F.col("c_mktsegment")
    customers = table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .otherwise(F.floor(F.lit(16) + F.col("c_acctbal") / 10000 * 64))
        .cast("int")
        .alias("age"),
        F.when(segment == "BUILDING", "ACTIVE")
        .when(segment == "AUTOMOBILE", "PRE-CREATE")
        .when(segment == "MACHINERY", "LEFT CLUB")
        .alias("club_member_status"),
        F.when(segment == "FURNITURE", "Regularly")
        .when(segment == "HOUSEHOLD", "Monthly")
        .when(segment == "BUILDING", "NONE")
        .alias("fashion_news_frequency"),
    )
    part_type = F.col("p_type")
    articles = table("part").select(
        F.col("p_partkey").alias("article_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_size").alias("product_type_no"),
        F.substring("p_brand", 7, 100).cast("int").alias("department_no"),
        F.when(part_type == "ECONOMY", 1)
        .when(part_type == "LARGE", 2)
        .when(part_type == "MEDIUM", 3)
        .when(part_type == "PROMO", 4)
        .when(part_type == "SMALL", 5)
        .otherwise(6)
        .alias("colour_group_code"),
        (F.col("p_size") % 8).alias("perceived_colour_value_id"),
    )
    return Inputs(transactions, articles, customers, TESTDATA)


def article_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("article_id"), F.col("embedding").alias("vector")
    )
