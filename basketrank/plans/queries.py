"""Every operator as a query over the order tables.

Each function takes (spark, folder of a scale factor) and returns a DataFrame.
Flags leave as int, doubles are rounded once at the end, and dates as text, so
that the results can be compared with another engine's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RANKER, SOURCES, RankerParams
from ..functions import age_group
from ..operators import (
    ablation, candidates, factorisation, features, lookup, metrics, nearest, neighbours, predict, ranker, sampling, stats, vectors,
)
from ..operators.candidates import PAIR
from ..sources import (
    Inputs, Stages, load_inputs, read_submission, read_tables, shared_dir, table_sizes, write_csv, write_parquet,
)
from . import pipeline
from .testdata import article_vectors, bind

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Widen small ints, round doubles, print dates.

    Engines round exact halves differently, so rounding is spelled out with a
    half moved up by a thousandth of the last digit. Prices are sums of many
    large values and keep four digits at most.
    """
    out = []
    for field in df.schema.fields:
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind == "tinyint":
            column = column.cast("int")
        elif kind in ("double", "float"):
            scale = F.lit(10.0 ** (min(digits, 4) if "price" in field.name else digits))
            column = F.floor(column.cast("double") * scale + F.lit(0.501)) / scale
        elif kind == "date":
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


# --- shared inputs ----------------------------------------------------------


def _pairs(inputs: Inputs, mode: str = "reference") -> DataFrame:
    calendar = inputs.calendar
    return stats.pair_activity(inputs.train_tx_clean, calendar, calendar.feature_as_of(mode))


def _recent(inputs: Inputs) -> DataFrame:
    return candidates.recent_activity(inputs.train_tx, inputs.calendar)


def _staged_recent(inputs: Inputs) -> DataFrame:
    """The same, written out, for queries that read it several times."""
    return Stages(inputs.transactions.sparkSession)("recent_activity", _recent(inputs))


def _merged(inputs: Inputs) -> DataFrame:
    return candidates.generate_candidates(_staged_recent(inputs), inputs.customers)


def _overlapping(inputs: Inputs) -> DataFrame:
    """Candidates with pairs that several sources share: repeat purchases of the
    last 90 days stand in for the factorisation, whose output is not expressible
    in SQL."""
    recent = _staged_recent(inputs)
    repeated = factorisation.interactions(recent).where(F.col("n") > 1)
    stand_in = repeated.select(*PAIR, F.lit("als").alias("source"))
    return candidates.generate_candidates(recent, inputs.customers, als=stand_in)


def _scored(inputs: Inputs, pivot: DataFrame) -> DataFrame:
    """A fixed score that needs no model: the decay weight of the pair."""
    weights = stats.pair_features(_pairs(inputs)).select(*PAIR, "user_item_decay_weight")
    score = F.round(F.coalesce("user_item_decay_weight", F.lit(0.0)), 6)
    return pivot.select(*PAIR).join(weights, PAIR, "left").select(*PAIR, score.alias("score"))


def _scored_candidates(inputs: Inputs) -> DataFrame:
    return _scored(inputs, candidates.source_pivot(_merged(inputs)))


def _labelled(inputs: Inputs) -> DataFrame:
    bought = inputs.label_tx.select(*PAIR).distinct().withColumn("label", F.lit(1))
    return _scored_candidates(inputs).join(bought, PAIR, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def _submission(inputs: Inputs) -> DataFrame:
    return predict.build_submission(
        _scored_candidates(inputs), inputs.train_tx, inputs.customers, inputs.calendar
    )


def _feature_table(
    spark: SparkSession, inputs: Inputs, labels: bool, mode: str = "reference", **extras: DataFrame
) -> DataFrame:
    stages = Stages(spark)
    pivot = stages("source_pivot", candidates.source_pivot(_merged(inputs)))
    statistics = features.build_statistics(
        inputs.train_tx_clean, inputs.articles, inputs.customers, inputs.calendar,
        inputs.calendar.feature_as_of(mode), stages,
    )
    return features.build_features(pivot, statistics, inputs.label_tx if labels else None, **extras)


# --- sources, splits, predicates --------------------------------------------


@query
def q_load_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(bind(spark, sf_dir).transactions)


@query
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables written as text, with padded ids, and read back by their column names."""
    inputs, folder = bind(spark, sf_dir), f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"

    def padded(df: DataFrame, *ids: str) -> DataFrame:
        own = df.withColumns({name: F.lpad(F.col(name).cast("string"), 10, "0") for name in ids})
        return own.select(*sorted(own.columns, reverse=True))

    write_csv(padded(inputs.transactions, "customer_id", "article_id"), f"{folder}/transactions_train.csv")
    write_csv(padded(inputs.articles, "article_id"), f"{folder}/articles.csv")
    write_csv(padded(inputs.customers, "customer_id"), f"{folder}/customers.csv")
    back = load_inputs(spark, folder, inputs.calendar)
    joined = back.transactions.join(back.articles, "article_id").join(back.customers, "customer_id")
    return tidy(joined.select(
        "t_dat", "customer_id", "article_id", "price", "prod_name", "product_type_no", "department_no", "colour_group_code",
        F.col("age").cast("int").alias("age"), "club_member_status", "fashion_news_frequency",
    ))


@query
def q_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases written in folders by month and read back from a list of folders and a glob."""
    inputs, folder = bind(spark, sf_dir), f"{shared_dir(spark)}/parquet-{uuid.uuid4().hex}"
    even = F.col("customer_id") % 2 == 0
    write_parquet(inputs.transactions.where(even).withColumn("year", F.year("t_dat")), f"{folder}/even", "year")
    write_parquet(inputs.transactions.where(~even), f"{folder}/odd")
    back = read_tables(spark, f"{folder}/even/year=*").unionByName(read_tables(spark, f"{folder}/odd"))
    return tidy(back)


@query
def q_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_sizes(bind(spark, sf_dir))


@query
def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    calendar, day = inputs.calendar, F.col("t_dat")
    return inputs.transactions.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(day < F.lit(calendar.test_start)).alias("n_train"),
        F.count_if(day < F.lit(calendar.val_start)).alias("n_clean"),
        F.count_if(day >= F.lit(calendar.test_start)).alias("n_test"),
    )


@query
def q_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    calendar = inputs.calendar
    windows = {**calendar.windows, "90d": calendar.quarter}
    return inputs.train_tx.agg(*[
        F.count_if(candidates.after("t_dat", calendar.last_train, days)).alias(f"n_{suffix}")
        for suffix, days in windows.items()
    ])


@query
def q_label_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(bind(spark, sf_dir).label_tx)


@query
def q_sample_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    chosen = inputs.customers.where(F.col("fashion_news_frequency") == "Regularly")
    return tidy(lookup.only_customers(inputs.transactions, chosen))


@query
def q_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = bind(spark, sf_dir).customers
    in_features = stats.customer_profile(customers).select("customer_id", F.col("age_group").alias("feature_stage"))
    return customers.select("customer_id", age_group("age").alias("candidate_stage")).join(in_features, "customer_id")


# --- candidates -------------------------------------------------------------


@query
def q_cand_repurchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return candidates.repurchase(_recent(inputs))


@query
def q_warm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return candidates.warm_customers(_recent(inputs), inputs.customers).select("customer_id")


@query
def q_popular_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return candidates.popular_by_age(_recent(inputs), inputs.customers)


@query
def q_cand_age_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return candidates.age_popular(_staged_recent(inputs), inputs.customers)


@query
def q_cand_global_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return candidates.global_popular(_staged_recent(inputs), inputs.customers)


@query
def q_id_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each index numbers its ids 0 .. n-1: told by count, range and distinctness."""
    inputs = bind(spark, sf_dir)
    counts = factorisation.interactions(_staged_recent(inputs))

    def described(column: str) -> DataFrame:
        index = factorisation.dense_index(counts, column, "idx")
        return index.agg(
            F.lit(column).alias("id_column"), F.count(F.lit(1)).alias("n"), F.countDistinct("idx").alias("n_index"),
            F.min("idx").alias("first_index"), F.max("idx").alias("last_index"),
        )

    return described("customer_id").unionByName(described("article_id"))


@query
def q_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return factorisation.interactions(_recent(inputs))


@query
def q_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return tidy(factorisation.bm25_weights(factorisation.interactions(_staged_recent(inputs))))


@query
def q_cand_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return factorisation.als_candidates(_staged_recent(inputs))


def _item_similarity(
    spark: SparkSession, sf_dir: str, params: neighbours.ItemItemParams = neighbours.ItemItemParams()
) -> tuple[DataFrame, DataFrame]:
    stages = Stages(spark)
    pairs = stages("interactions", factorisation.interactions(_recent(bind(spark, sf_dir))).select(*PAIR))
    return pairs, stages("neighbours", neighbours.item_similarity(pairs, params, stages))


@query
def q_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 nearest of all articles that have a common buyer."""
    return tidy(_item_similarity(spark, sf_dir, neighbours.ItemItemParams(threshold=0.0))[1])


@query
def q_cand_item_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.item_item_candidates(*_item_similarity(spark, sf_dir))


def _profiles(spark: SparkSession, inputs: Inputs, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers' vectors, and those of the articles on sale."""
    known = article_vectors(spark, sf_dir).join(inputs.articles.select("article_id"), "article_id", "left_semi")
    return vectors.customer_vectors(stats.pair_features(_pairs(inputs)), known), known


@query
def q_cand_embedding_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.embedding_candidates(*_profiles(spark, bind(spark, sf_dir), sf_dir))


@query
def q_cand_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(bind(spark, sf_dir))


@query
def q_source_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(candidates.source_pivot(_overlapping(bind(spark, sf_dir))))


# --- statistics -------------------------------------------------------------


def _customer_stats(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    activity = stats.customer_activity(_pairs(inputs, mode), inputs.calendar, inputs.calendar.feature_as_of(mode))
    return tidy(activity.drop("days_since_last_purchase", "cust_avg_price"))


@query
def q_customer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_stats(spark, sf_dir, "reference")


@query
def q_customer_stats_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_stats(spark, sf_dir, "fixed")


@query
def q_customer_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    activity = stats.customer_activity(_pairs(inputs), inputs.calendar, inputs.calendar.feature_as_of())
    return activity.select("customer_id", "days_since_last_purchase")


@query
def q_age_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.age_median(bind(spark, sf_dir).customers))


@query
def q_customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.customer_profile(bind(spark, sf_dir).customers))


def _article_stats(spark: SparkSession, sf_dir: str, mode: str, *cols: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    activity = stats.article_activity(_pairs(inputs, mode), inputs.calendar, inputs.calendar.feature_as_of(mode))
    return tidy(activity.select("article_id", *cols))


@query
def q_article_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "reference", "article_popularity_7d", "article_popularity_14d")


@query
def q_article_popularity_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "fixed", "article_popularity_7d", "article_popularity_14d")


@query
def q_age_article_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return stats.age_article_popularity(_pairs(inputs), stats.customer_profile(inputs.customers))


@query
def q_article_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "reference", "days_since_article_last_sold")


@query
def q_article_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "reference", "article_age_days")


@query
def q_sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "reference", "sales_trend")


@query
def q_sales_trend_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "fixed", "sales_trend")


@query
def q_season_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _article_stats(spark, sf_dir, "reference", "autumn_2019_sales").where(F.col("autumn_2019_sales").isNotNull())


@query
def q_avg_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    calendar, pairs = inputs.calendar, _pairs(inputs)
    customer = stats.customer_activity(pairs, calendar, calendar.feature_as_of())
    article = stats.article_activity(pairs, calendar, calendar.feature_as_of())
    return tidy(
        customer.select(F.lit("customer").alias("side"), F.col("customer_id").alias("id"), F.col("cust_avg_price").alias("avg_price"))
        .unionByName(article.select(F.lit("article").alias("side"), F.col("article_id").alias("id"), F.col("art_avg_price").alias("avg_price")))
    )


@query
def q_user_item_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.pair_features(_pairs(bind(spark, sf_dir))).select(*PAIR, "user_item_decay_weight"))


@query
def q_user_bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.pair_features(_pairs(bind(spark, sf_dir))).select(*PAIR, "user_has_bought_before"))


@query
def q_user_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pair_features(_pairs(bind(spark, sf_dir))).select(*PAIR, "user_item_purchase_count")


@query
def q_user_prod_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return stats.user_product_types(_pairs(inputs), inputs.articles)


@query
def q_user_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return stats.user_departments(_pairs(inputs), inputs.articles)


@query
def q_dept_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return tidy(stats.department_affinity(_pairs(inputs), inputs.articles))


# --- features, labels, samples ----------------------------------------------


@query
def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_feature_table(spark, bind(spark, sf_dir), labels=False))


@query
def q_features_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_feature_table(spark, bind(spark, sf_dir), labels=False, mode="fixed"))


@query
def q_features_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = vectors.vector_columns(article_vectors(spark, sf_dir), 64)
    feats = _feature_table(spark, bind(spark, sf_dir), labels=False, image_vectors=columns)
    return tidy(feats.select(*PAIR, *[c for c in feats.columns if c.startswith("img_feat_")]))


@query
def q_train_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_feature_table(spark, bind(spark, sf_dir), labels=True))


@query
def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(bind(spark, sf_dir)).select(*PAIR, "label")


@query
def q_sample_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(bind(spark, sf_dir)).select(*PAIR, "label")
    return sampling.sample_negatives(Stages(spark)("labels", labelled), ratio=10)


@query
def q_sample_negatives_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sampler ordered by a hash that SQL can compute too."""
    labelled = _labelled(bind(spark, sf_dir)).select(*PAIR, "label")
    key = (F.col("customer_id") * 1000003 + F.col("article_id") * 7919 + 42) % 2147483647
    return sampling.sample_negatives(Stages(spark)("labels", labelled), ratio=10, key=key, key_bits=31)


@query
def q_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.group_sizes(q_sample_negatives_exact(spark, sf_dir))


# --- ranker -----------------------------------------------------------------


@query
def q_ndcg12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(metrics.ndcg(_labelled(bind(spark, sf_dir))))


@query
def q_als_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: how many articles ALS gives, and how many of them were bought already."""
    recent = _staged_recent(bind(spark, sf_dir))
    given = Stages(spark)("als", factorisation.als_candidates(recent).select(*PAIR))
    bought = factorisation.interactions(recent).select(*PAIR, F.lit(1).alias("bought"))
    return given.join(bought, PAIR, "left").groupBy("customer_id").agg(
        F.countDistinct("article_id").alias("n_given"), F.count("bought").alias("n_bought")
    )


@query
def q_lambdas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranker.with_ideal(_labelled(bind(spark, sf_dir)))
    return tidy(ranker.lambda_gradients(Stages(spark)("labelled", rows)).select(*PAIR, "lambda", "hessian"))


@query
def q_lambdas_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradients from pairs with a row among the first 30, scaled per customer."""
    rows = ranker.with_ideal(_labelled(bind(spark, sf_dir)), 30)
    return tidy(ranker.normalised_gradients(Stages(spark)("labelled", rows), 30).select(*PAIR, "lambda", "hessian"))


def _training_table(spark: SparkSession, sf_dir: str, stages: Stages) -> DataFrame:
    """Labelled feature rows made as training makes them: candidates and features know nothing of the label week."""
    inputs = bind(spark, sf_dir)
    as_of = inputs.calendar.feature_as_of("fixed")
    recent = stages("training_activity", candidates.recent_activity(inputs.train_tx_clean, inputs.calendar, as_of))
    pivot = stages("training_pivot", candidates.source_pivot(candidates.generate_candidates(recent, inputs.customers, distinct=False)))
    statistics = features.build_statistics(
        inputs.train_tx_clean, inputs.articles, inputs.customers, inputs.calendar, as_of, stages
    )
    return stages("training_features", features.build_features(pivot, statistics, inputs.label_tx))


def _fitted(
    spark: SparkSession, sf_dir: str, params: RankerParams = RANKER, ratio: int = 10
) -> tuple[ranker.Ranker, DataFrame, DataFrame]:
    stages = Stages(spark)
    table = _training_table(spark, sf_dir, stages)
    sampled = stages("sampled", sampling.sample_negatives(table, ratio=ratio))
    return ranker.fit_ranker(sampled, params, stages=stages), table, sampled


#: For queries that check the trainer: few rounds of small trees, watched on the training rows.
CHECKED = replace(RANKER, rounds=12, learning_rate=0.3, max_depth=4, min_rows_per_leaf=5, watch="train")


@query
def q_ranker_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, table, _ = _fitted(spark, sf_dir)
    return tidy(model.score(table))


@query
def q_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = _fitted(spark, sf_dir)
    return tidy(model.importances(spark))


@query
def q_ranker_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates and customers scored, scores that are no number, whether several trees were kept, and whether the
    rows trained on are ranked better than by any single source."""
    model, table, sampled = _fitted(spark, sf_dir, CHECKED, ratio=50)
    known = model.score(table)
    own = Stages(spark)("own_scores", model.score(sampled).join(sampled.drop("score"), PAIR))

    def mean_ndcg(score: Column) -> DataFrame:
        rows = own.select(*PAIR, "label", score.cast("double").alias("score"))
        return metrics.ndcg(rows).agg(F.avg("ndcg").alias("ndcg"))

    singles = [mean_ndcg(F.col(f"candidate_source_{name}")) for name in SOURCES]
    best = reduce(DataFrame.unionByName, singles).agg(F.max("ndcg").alias("single"))
    bad = F.col("score").isNull() | F.isnan("score") | (F.abs("score") == float("inf"))
    return known.agg(
        F.count(F.lit(1)).alias("n_scored"), F.countDistinct("customer_id").alias("n_customers"), F.count_if(bad).alias("n_not_finite"),
    ).select(
        "*", F.lit(model.ensemble.getNumTrees > 1).alias("several_trees"),
        (mean_ndcg(F.col("score")).scalar() > best.scalar()).alias("better_than_a_source"),
    )


@query
def q_model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates scored by a model and by the same one saved and loaded, and how many scores differ."""
    model, table, _ = _fitted(spark, sf_dir, replace(CHECKED, rounds=3), ratio=50)
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    model.save(spark, path)
    again = ranker.Ranker.load(spark, path).score(table).withColumnRenamed("score", "again")
    both = model.score(table).join(again, PAIR)
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(~F.col("score").eqNullSafe(F.col("again"))).alias("n_different"))


# --- ranking, submission, evaluation ----------------------------------------


@query
def q_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(predict.top_per_customer(_scored_candidates(bind(spark, sf_dir)), 50))


@query
def q_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = predict.ranked_lists(predict.top_per_customer(_scored_candidates(bind(spark, sf_dir))))
    return lists.select("customer_id", F.array_join(F.col("top12").cast("array<string>"), " ").alias("top12"))


@query
def q_global_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return predict.global_top(inputs.train_tx, inputs.calendar)


@query
def q_missing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return predict.missing_customers(inputs.customers, _merged(inputs))


@query
def q_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _submission(bind(spark, sf_dir))


@query
def q_submission_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The submission written as CSV and read back as the evaluation reads it."""
    path = f"{shared_dir(spark)}/submission-{uuid.uuid4().hex}"
    write_csv(_submission(bind(spark, sf_dir)), path)
    return read_submission(spark, path)


@query
def q_pipeline_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate part of the whole pipeline, with all sources that need no trained model."""
    options = pipeline.Options(
        als=None, training=False, prediction=False, evaluation=False, global_popular=True,
        item_item=neighbours.ItemItemParams(), embedding=nearest.NearestParams(),
    )
    out = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    return tidy(pipeline.run(bind(spark, sf_dir), out, options, similarity_vectors=article_vectors(spark, sf_dir))["candidates"])


@query
def q_pipeline_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline from candidates to the written submission, without ALS: per customer the articles in its list, and
    how many of them are among its candidates."""
    options = pipeline.Options(als=None, evaluation=False, neg_ratio=50, ranker=CHECKED)
    out = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    made = pipeline.run(bind(spark, sf_dir), out, options)
    listed = metrics.predicted_rows(made["submission"]).select(*[F.col(c).cast("long").alias(c) for c in PAIR])
    known = made["candidates"].select(*PAIR, F.lit(1).alias("known"))
    return listed.join(known, PAIR, "left").groupBy("customer_id").agg(
        F.countDistinct("article_id").alias("n_listed"), F.count("known").alias("n_candidates")
    )


@query
def q_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repurchase candidates of a run, of one that resumes it, and of one that resumes it with fewer customers."""
    inputs, out = bind(spark, sf_dir), f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    options = pipeline.Options(als=None, training=False, prediction=False, evaluation=False, resume=True)
    fewer = replace(inputs, customers=inputs.customers.where(F.col("club_member_status").isNotNull()))
    counts = []
    for name, given in (("first", inputs), ("resumed", inputs), ("fewer customers", fewer)):
        made = pipeline.run(given, out, options)["candidates"].where("candidate_source_repurchase = 1")
        counts.append(made.agg(F.lit(name).alias("run"), F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("customer_id").alias("n_customers")))
    return reduce(DataFrame.unionByName, [Stages(spark)("counts", one) for one in counts])


@query
def q_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ground_truth(bind(spark, sf_dir).test_tx)


@query
def q_ap12(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    predicted = metrics.predicted_rows(_submission(inputs))
    return tidy(metrics.average_precision(metrics.truth_pairs(inputs.test_tx), predicted))


@query
def q_map12(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return tidy(metrics.evaluate_submission(inputs.test_tx, _submission(inputs)), 9)


def _ablation(spark: SparkSession, sf_dir: str, dedupe: bool) -> DataFrame:
    inputs, stages = bind(spark, sf_dir), Stages(spark)
    pivot = stages("source_pivot", candidates.source_pivot(_overlapping(inputs)))
    scored = stages("scored", _scored(inputs, pivot))
    submission = predict.build_submission(scored, inputs.train_tx, inputs.customers, inputs.calendar)
    baseline = stages("baseline", metrics.evaluate_submission(inputs.test_tx, submission))
    return tidy(ablation.ablation(
        scored, pivot, inputs.transactions, inputs.test_tx, inputs.customers, inputs.calendar, baseline, dedupe
    ), 9)


@query
def q_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ablation(spark, sf_dir, dedupe=True)


@query
def q_ablation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ablation(spark, sf_dir, dedupe=False)


# --- look-ups ---------------------------------------------------------------


@query
def q_recommendation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return lookup.recommendation_lookup(_submission(inputs), inputs.articles)


@query
def q_recent_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    return tidy(lookup.recent_purchases(inputs.transactions, inputs.articles))


# --- vectors ----------------------------------------------------------------


@query
def q_vector_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(vectors.vector_columns(article_vectors(spark, sf_dir), 64))


@query
def q_pca_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the reduced vectors have mean 0, no covariance between dimensions and falling variances."""
    table = article_vectors(spark, sf_dir)
    reduced = Stages(spark)("reduced", vectors.reduce_vectors(vectors.fit_pca(table), table))
    places = range(vectors.IMAGE_DIMS)
    value = [F.col("vector")[i].cast("double") for i in places]
    row = reduced.agg(
        F.count(F.lit(1)).alias("n_vectors"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(value)],
        *[F.var_pop(v).alias(f"v{i}") for i, v in enumerate(value)],
        *[F.corr(value[i], value[i + 1]).alias(f"c{i}") for i in places if i + 1 in places],
    )
    spread = F.sqrt("v0")
    return row.select(
        "n_vectors",
        F.forall(F.array(*[f"m{i}" for i in places]), lambda m: F.abs(m) < 1e-5 * spread).alias("centred"),
        F.forall(F.array(*[f"c{i}" for i in places[:-1]]), lambda c: F.abs(c) < 1e-3).alias("uncorrelated"),
        F.forall(F.array(*[F.struct(F.col(f"v{i}").alias("a"), F.col(f"v{i + 1}").alias("b")) for i in places[:-1]]), lambda p: p["a"] >= p["b"]).alias("falling"),
    )


@query
def q_pca32(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = article_vectors(spark, sf_dir)
    return tidy(vectors.vector_columns(vectors.reduce_vectors(vectors.fit_pca(table), table)))


@query
def q_embedding_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = bind(spark, sf_dir)
    pairs = candidates.source_pivot(_merged(inputs))
    return tidy(vectors.embedding_similarity(pairs, stats.pair_features(_pairs(inputs)), article_vectors(spark, sf_dir)))


