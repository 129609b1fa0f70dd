"""The registered corpus queries: their SQL, their names, and the pipeline against its operators."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from basketrank.llm import exactdedup, neardedup, queries, repetition, toxicity  # noqa: E402
from basketrank.llm.common import staged, table  # noqa: E402
from check import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= {*contract.queries()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "exact_dedup", "near_dedup", "packing"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for name_of_table in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {name_of_table} AS SELECT * FROM read_parquet('{Path(SF) / name_of_table}.parquet')")
    df, result = queries.QUERIES[name](spark, SF), db.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", ["op1_token_counts", "op3_lm_score", "op5_minhash_near_dedup", "op7_html_text", "op9_toxicity"])
def test_query_has_a_row_for_each_input_row(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    assert rows.count() == table(spark, SF, "pages" if "html" in name else "documents").count()


def test_pipeline_stages_do_what_their_operators_say(spark):
    docs = staged(table(spark, SF, "documents"), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        judged = {
            "quality_rules": lambda: repetition.repetition(docs),
            "toxicity": lambda: toxicity.toxicity(docs, table(spark, SF, "labels")),
            "exact_dedup": lambda: exactdedup.exact_duplicates(docs),
            "near_dedup": lambda: neardedup.near_duplicates(docs, 5, 80),
        }[name]()
        assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in judged.where("kept").collect()), name
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
    assert {(r.doc_id, r.start, r.length) for r in corpus_pipeline.run(spark, SF).collect()} and len(pieces) >= docs.count()


def test_an_empty_table_goes_through_all_stages(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_stages_take_names_that_differ_in_case_only(spark, clashing):
    words = " ".join(f"word{i}" for i in range(30))
    docs = clashing.unionByName(spark.createDataFrame([(9, "Wrong", words, "en", 1, 2, "i", "k", 3, 4, 5)], clashing.schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == clashing.columns
        assert [tuple(r)[:3] for r in docs.collect()] == [(9, "Wrong", words)]
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} == {9}
