from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from basketrank.operators.lookup import only_customers, recent_purchases, recommendation_lookup
from basketrank.sources import storage
from basketrank.sources.tables import TRANSACTIONS, read_csv
from basketrank.sources import Stages, content_mark, join_catalogue, load_inputs, read_submission, read_tables, shared_dir, table_sizes, write_csv, write_parquet


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "transactions_train.csv").write_text(
        "t_dat,customer_id,article_id,price,sales_channel_id\n"
        "2020-09-05,00a,0108775015,0.05,1\n2020-09-10,00a,0108775015,0.05,1\n2020-09-17,00b,0108775044,0.02,2\n"
    )
    (tmp_path / "articles.csv").write_text(
        "article_id,product_code,prod_name,product_type_no,colour_group_code,department_no,perceived_colour_value_id\n"
        '0108775015,108775,"Strap, top",253,9,1676,4\n'
    )
    (tmp_path / "customers.csv").write_text(
        "customer_id,FN,Active,club_member_status,fashion_news_frequency,age\n00a,,,ACTIVE,Regularly,24.0\n00b,,,,,\n"
    )
    return str(tmp_path)


def test_csv_scan_keeps_ids_as_text_and_finds_columns_by_name(spark, csv_dir, calendar):
    inputs = load_inputs(spark, csv_dir, calendar)
    first = inputs.transactions.orderBy("t_dat").first()
    assert tuple(first) == (date(2020, 9, 5), "00a", "0108775015", 0.05)
    assert inputs.articles.first().prod_name == "Strap, top"
    assert {r.customer_id: r.age for r in inputs.customers.collect()} == {"00a": 24.0, "00b": None}
    assert (inputs.train_tx.count(), inputs.train_tx_clean.count(), inputs.label_tx.count(), inputs.test_tx.count()) == (2, 1, 1, 1)
    sizes = {r.table_name: (r.n_rows, r.n_columns) for r in table_sizes(inputs).collect()}
    assert sizes == {"transactions": (3, 4), "train_tx_clean": (1, 4), "articles": (1, 6), "customers": (2, 4)}


def test_files_with_other_headers_are_refused(spark, csv_dir, calendar, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("t_dat,customer_id,article_id,price\n2020-09-05,00a,0108775015,0.05\n")
    assert read_csv(spark, str(folder), TRANSACTIONS).count() == 1
    (folder / "b.csv").write_text("t_dat,article_id,customer_id,price\n2020-09-05,0108775015,00a,0.05\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder), TRANSACTIONS).collect()


def test_submission_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "s.csv").write_text("prediction,customer_id\n0108775015 0108775044,00a\n")
    assert tuple(read_submission(spark, str(tmp_path / "s.csv")).first()) == ("00a", "0108775015 0108775044")


def test_content_mark_follows_the_rows_only(spark):
    rows = [(1, "a", 0.5), (2, None, 1.5), (2, None, 1.5)]
    mark = content_mark(spark.createDataFrame(rows, "x int, y string, z double"))
    assert content_mark(spark.createDataFrame(rows[::-1], "x int, y string, z double").repartition(3)) == mark
    for other in (rows[:2], [(1, "a", 0.5), (2, None, 1.5), (2, "", 1.5)]):
        assert content_mark(spark.createDataFrame(other, "x int, y string, z double")) != mark


def test_a_named_table_keeps_two_folders_at_most(spark, tmp_path):
    for n in range(4):
        assert Stages(spark, str(tmp_path))("t", spark.range(n), {"n": n}).count() == n
        assert Stages(spark, str(tmp_path)).read("t").count() == n
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["data-0", "data-1", "last"]


def test_catalogue_join_deals_out_popular_keys(spark, monkeypatch):
    rows = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 7 + 2).alias("article_id"), F.col("id").alias("customer_id"))
    catalogue = spark.range(1, 6).select(F.col("id").cast("int").alias("article_id"), (F.col("id") * 10).alias("x"))
    small = join_catalogue(rows, catalogue, "article_id", "customer_id")
    monkeypatch.setattr(storage, "fits_broadcast", lambda df: False)
    spread = join_catalogue(rows, catalogue, "article_id", "customer_id")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, spread.collect()), key=str)
    assert spread.columns == small.columns and small.where("x is null").count() > 0


def test_large_catalogue_moves_once_but_for_popular_keys(spark, monkeypatch, tmp_path):
    # Written out, it is so small a file that Spark would broadcast it, whatever the parts make of it.
    spark.range(5000).select(F.col("id").alias("article_id"), (F.col("id") * 10).alias("x")).write.parquet(str(tmp_path / "c"))
    catalogue = spark.read.parquet(str(tmp_path / "c"))
    rows = spark.range(20000).select(F.when(F.col("id") < 9000, 7).otherwise(F.col("id") % 5000).alias("article_id"), F.col("id").alias("customer_id"))
    monkeypatch.setattr(storage, "fits_broadcast", lambda df: False)
    assert storage.popular_keys(rows, "article_id") == [7]
    joined = join_catalogue(rows, catalogue, "article_id", "customer_id")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    assert joined.where("x = article_id * 10").count() == 20000
    moved = []
    monkeypatch.setattr(type(catalogue), "hint", lambda df, *_: moved.append(df.count()) or df)
    join_catalogue(rows, catalogue, "article_id", "customer_id")
    assert moved == [5000 + storage.SPREAD - 1]


def test_broadcasts_are_measured(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert storage.fits_broadcast(wide) and not storage.fits_broadcast(wide, max_rows=9) and not storage.fits_broadcast(wide, max_bytes=9000)


def test_submission_round_trip(spark, tmp_path):
    path = str(tmp_path / "submission")
    write_csv(spark.createDataFrame([("00a", "0108775015 0108775044")], "customer_id string, prediction string"), path)
    assert tuple(read_submission(spark, path).first()) == ("00a", "0108775015 0108775044")


def test_parquet_from_directory_files_and_glob(spark, tmp_path):
    for i in range(2):
        write_parquet(spark.range(3), str(tmp_path / f"part_{i}"))
    assert read_tables(spark, str(tmp_path / "part_0")).count() == 3
    assert read_tables(spark, str(tmp_path / "part_0"), str(tmp_path / "part_1")).count() == 6
    assert read_tables(spark, str(tmp_path / "part_*")).count() == 6


def test_stage_is_reused_only_with_the_same_settings(spark, tmp_path):
    root = str(tmp_path / "stages")
    Stages(spark, root)("t", spark.range(3), {"n": 1})
    again = Stages(spark, root, resume=True)
    assert again("t", spark.range(5), {"n": 1}).count() == 3
    assert again("t", spark.range(5), {"n": 2}).count() == 5
    assert Stages(spark, root)("t", spark.range(7), {"n": 1}).count() == 7
    assert again.read("t").count() == 7
    with pytest.raises(FileNotFoundError):
        again.read("other")
    with pytest.raises(ValueError):
        Stages(spark, resume=True)


def test_shared_folder_comes_from_the_session():
    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master)
        )

    assert shared_dir(session("yarn", "/shared/place/")) == "/shared/place"
    with pytest.raises(ValueError):
        shared_dir(session("yarn", None))


def test_lookups(spark, articles, transactions):
    table = articles([("0108775015", "Strap top", 1, 1, 1, 1)])
    submission = spark.createDataFrame([("a", "108775015 12345678901")], "customer_id string, prediction string")
    rows = [tuple(r) for r in recommendation_lookup(submission, table).orderBy("rank").collect()]
    assert rows == [
        ("a", 1, "0108775015", "Strap top", "images/0108775015.jpg"),
        ("a", 2, "12345678901", "Unknown Product", "images/12345678901.jpg"),
    ]
    tx = transactions([(f"2020-09-{d:02d}", "a", "0108775015", 1.0) for d in range(1, 9)] + [("2020-09-08", "a", "0000000001", 1.0)])
    recent = recent_purchases(tx, table).orderBy("rank").collect()
    assert [(r.t_dat.day, r.prod_name) for r in recent] == [(8, None), (8, "Strap top"), (7, "Strap top"), (6, "Strap top"), (5, "Strap top")]
    chosen = spark.createDataFrame([("a",)], "customer_id string")
    assert only_customers(tx.withColumn("customer_id", F.lit("b")), chosen).count() == 0
