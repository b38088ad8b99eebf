"""Every registered query: against its SQL, on hard tables, and on empty ones."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from compare import assert_same  # noqa: E402
from conftest import SF, duck_over  # noqa: E402,F401

from marketlens.llm import registry  # noqa: E402

QUERIES = registry.queries() | {"pipeline": corpus_pipeline.run}
SQL = registry.oracle_sql() | {"pipeline": corpus_pipeline.ORACLE_SQL}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_its_sql(spark, name):
    assert_same(QUERIES[name](spark, SF), duck_over(SF), SQL[name])


#: What SQL says on the hard documents holds where ids are unique; where they repeat, the tests below say.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hard_tables_do_not_fail(spark, hard, name):
    found = QUERIES[name](spark, hard).collect()
    assert found
    if name in ("op2_mix_sources", "op4_decontaminate", "op5_language_id", "op7_toxicity", "op8_line_dedup", "op9_near_duplicates",
                "op10_order_minhash"):
        ids = [r[0] for r in duck_over(hard).execute("SELECT doc_id FROM documents").fetchall()]
        assert sorted(ids, key=str) == sorted((r.doc_id for r in found), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_stages_keep_the_columns_of_documents(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, hard).columns == docs.columns
