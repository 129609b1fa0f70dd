from helpers import as_set

from basketrank.config import SOURCES
from basketrank.operators import candidates as c
from basketrank.operators.factorisation import bm25_weights, dense_index, interactions

PAIR = ("customer_id", "article_id")


def recent(transactions, calendar, rows):
    return c.recent_activity(transactions(rows), calendar)


def test_repurchase_keeps_distinct_pairs_of_14_days(transactions, calendar):
    table = recent(transactions, calendar, [
        ("2020-09-10", "a", "1", 1.0), ("2020-09-11", "a", "1", 1.0), ("2020-09-01", "a", "2", 1.0), ("2020-09-02", "b", "2", 1.0),
    ])
    assert sorted(map(tuple, c.repurchase(table).collect())) == [("a", "1", "repurchase"), ("b", "2", "repurchase")]


def test_warm_customers_bought_in_90_days_but_not_in_14(transactions, customers, calendar):
    table = recent(transactions, calendar, [
        ("2020-09-05", "both", "1", 1.0), ("2020-07-17", "both", "1", 1.0),
        ("2020-07-17", "warm", "1", 1.0), ("2020-06-07", "cold", "1", 1.0), ("2020-07-17", "unknown", "1", 1.0),
    ])
    known = customers([("both", 20.0), ("warm", 20.0), ("cold", 20.0)])
    assert as_set(c.warm_customers(table, known), "customer_id") == {("warm",)}


def test_age_popular_ties_go_to_the_lower_id_and_null_age_counts_as_oldest(transactions, customers, calendar):
    sold = [("2020-09-10", "buyer", f"{i:03d}", 1.0) for i in range(120)]
    table = recent(transactions, calendar, sold + [("2020-07-17", "warm", "x", 1.0), ("2020-07-17", "young", "x", 1.0)])
    known = customers([("buyer", None), ("warm", 70.0), ("young", 20.0)])
    made = c.age_popular(table, known)
    assert as_set(made, *PAIR) == {("warm", f"{i:03d}") for i in range(100)}


def test_global_popular_serves_customers_idle_for_90_days(transactions, customers, calendar):
    table = recent(transactions, calendar, [
        ("2020-09-10", "a", "1", 1.0), ("2020-09-10", "b", "1", 1.0), ("2020-09-10", "b", "2", 1.0), ("2020-09-05", "b", "3", 1.0),
    ])
    made = c.global_popular(table, customers([("a", 1.0), ("b", 1.0), ("idle", 1.0)]), top=2)
    assert as_set(made, *PAIR) == {("idle", "1"), ("idle", "2")}


def test_merge_drops_unknown_customers_and_duplicates(spark, customers):
    rows = [("a", "1", "als"), ("a", "1", "als"), ("a", "1", "repurchase"), ("gone", "1", "als")]
    merged = c.merge_candidates([spark.createDataFrame(rows, "customer_id string, article_id string, source string")], customers([("a", 1.0)]))
    assert sorted(map(tuple, merged.collect())) == [("a", "1", "als"), ("a", "1", "repurchase")]
    pivot = c.source_pivot(merged).collect()
    assert len(pivot) == 1
    flags = {s: pivot[0][f"candidate_source_{s}"] for s in SOURCES}
    assert flags == {s: int(s in ("als", "repurchase")) for s in SOURCES}


def test_dense_index_numbers_distinct_ids_whatever_the_partitions(spark):
    ids = spark.range(5000).selectExpr("cast(id % 2000 as string) as k")
    first = {r.k: r.i for r in dense_index(ids, "k", "i").collect()}
    again = {r.k: r.i for r in dense_index(ids.repartition(13), "k", "i").collect()}
    assert sorted(first.values()) == list(range(2000)) and first == again


def test_bm25_of_an_article_everyone_bought_is_slightly_negative(transactions, calendar):
    counts = interactions(recent(transactions, calendar, [
        ("2020-09-10", "a", "1", 1.0), ("2020-09-10", "b", "1", 1.0), ("2020-09-10", "b", "2", 1.0),
    ]))
    weights = {(r.customer_id, r.article_id): r.weight for r in bm25_weights(counts).collect()}
    assert weights["a", "1"] < 0 and weights["b", "2"] == 0
