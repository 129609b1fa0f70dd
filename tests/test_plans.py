"""What the plans must and must not contain."""

from basketrank.operators import candidates, features, predict, stats
from basketrank.plans import queries
from basketrank.plans.testdata import bind
from basketrank.session import PARTS, tune
from basketrank.sources import storage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_plans_a_cartesian_product(spark):
    for name in ("q_cand_merged", "q_submission", "q_map12", "q_embedding_similarity", "q_ndcg12", "q_bm25", "q_cand_als"):
        text = plan(queries.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_ranking_cuts_before_the_shuffle(spark):
    inputs = bind(spark, SF)
    recent = candidates.recent_activity(inputs.train_tx, inputs.calendar)
    assert plan(candidates.popular_by_age(recent, inputs.customers)).count("WindowGroupLimit") == 2
    scored = spark.range(1000).selectExpr("id % 3 as customer_id", "id as article_id", "rand(1) as score")
    assert plan(predict.top_per_customer(scored)).count("WindowGroupLimit") == 2


def test_top_list_is_no_global_sort(spark):
    inputs = bind(spark, SF)
    assert "TakeOrderedAndProject" in plan(predict.global_top(inputs.train_tx, inputs.calendar))


def test_statistics_need_one_scan_and_fold_before_the_shuffle(spark, tmp_path):
    transactions = bind(spark, SF).transactions
    transactions.write.parquet(str(tmp_path / "tx"))
    inputs = bind(spark, SF)
    pairs = stats.pair_activity(spark.read.parquet(str(tmp_path / "tx")).where("t_dat < '2001-02-01'"), inputs.calendar, inputs.calendar.last_train)
    text = plan(stats.customer_activity(pairs, inputs.calendar, inputs.calendar.last_train))
    assert text.count("FileScan") == 1 and "LessThan(t_dat" in text and "Expand" not in text


def test_feature_rows_are_joined_by_three_keys(spark):
    inputs = bind(spark, SF)
    pivot = candidates.source_pivot(candidates.generate_candidates(candidates.recent_activity(inputs.train_tx, inputs.calendar), inputs.customers))
    statistics = features.build_statistics(inputs.train_tx_clean, inputs.articles, inputs.customers, inputs.calendar, inputs.calendar.last_train)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = queries.Stages(spark)("pivot", pivot)
        text = plan(features.build_features(staged, statistics))
        broadcasts = text.count("BroadcastHashJoin")
        assert broadcasts == 1  # the catalogue, counted first
        joins = broadcasts + text.count("SortMergeJoin") + text.count("ShuffledHashJoin")
        # The subqueries for the mean prices have a join each.
        subqueries = sum("- Subquery " in line for line in text.splitlines())
        assert joins - subqueries == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidates_of_popular_articles_do_not_move_by_article(spark, monkeypatch):
    inputs = bind(spark, SF)
    pivot = queries.Stages(spark)("pivot", candidates.source_pivot(candidates.generate_candidates(candidates.recent_activity(inputs.train_tx, inputs.calendar), inputs.customers)))
    statistics = features.build_statistics(inputs.train_tx_clean, inputs.articles, inputs.customers, inputs.calendar, inputs.calendar.last_train)
    broadcast = features.build_features(pivot, statistics)
    monkeypatch.setattr(features, "fits_broadcast", lambda df: False)
    # So that some articles are popular here and some are not.
    monkeypatch.setattr(storage, "POPULAR", 1 / 180)
    popular = storage.popular_keys(pivot, "article_id")
    assert 0 < len(popular) < pivot.select("article_id").distinct().count()
    moved = []
    monkeypatch.setattr(type(pivot), "hint", lambda df, *_: moved.append(df.select("article_id").distinct().collect()) or df)
    spread = features.build_features(pivot, statistics)
    assert len(moved) == 1 and not {r.article_id for r in moved[0]} & set(popular)
    assert spread.columns == broadcast.columns
    assert spread.exceptAll(broadcast).count() == 0 and spread.count() == broadcast.count() == pivot.count()


def test_a_tasks_rows_do_not_grow_with_the_table(spark):
    bind(spark, SF)
    # 50 MB after compression, for a session of 4 shuffle partitions.
    rows = spark.range(6_000_000).selectExpr("id % 100000 as k", "rand(3) as x").repartition("k")
    tasks = rows.selectExpr("spark_partition_id() as part", "x").groupBy("part").agg({"x": "max"})
    assert len(tasks.collect()) > 4


def test_settings_of_the_session_itself_stay(spark):
    held = {}

    class Conf:
        def __init__(self, given):
            self.given = given

        def get(self, key):
            return self.given.get(key)

        def set(self, key, value):
            held[key] = value

    def tuned(**given):
        held.clear()
        conf = Conf({key.replace("_", "."): value for key, value in given.items()})
        context = type("Context", (), {"getConf": staticmethod(lambda: conf)})
        tune(type("Session", (), {"conf": conf, "sparkContext": context}))
        return held

    assert tuned(spark_sql_shuffle_partitions="12")[PARTS] == "200"
    assert tuned(spark_sql_shuffle_partitions="900")[PARTS] == "900"
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" not in tuned(**{
        "spark_sql_shuffle_partitions": "12", "spark_sql_adaptive_advisoryPartitionSizeInBytes": "1m",
    })
