"""Every registered query against its SQL in another engine, at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
RECOMMENDER = sorted(name for name in contract.queries() if name.startswith("q_"))
NO_SQL = {"q_cand_als", "q_sample_negatives", "q_ranker_scores", "q_importance", "q_pca32"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(SF) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_only_trained_and_hashed_results_have_no_sql():
    assert set(RECOMMENDER) - set(contract.oracle_sql()) == NO_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(set(RECOMMENDER) - NO_SQL))
def test_query_equals_its_sql(name, spark, db):
    df = contract.queries()[name](spark, SF)
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
