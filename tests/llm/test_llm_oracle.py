"""Queries with an oracle equal their DuckDB SQL on the sf0.001 tables; the others run over all documents."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from scorewright.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
OTHER_ROWS = {"op11_phrase_collocations", "op13_conversation_trie"}  # rows of phrases and of nodes


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_oracle(spark, name):
    import compare

    r = compare.compare(spark, compare.duck(SF), name, Q.QUERIES[name], Q.ORACLE[name], SF)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - OTHER_ROWS))
def test_one_row_a_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.QUERIES[name](spark, SF)
    assert got.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
    assert got.count() == docs.count()


def test_all_operators():
    assert [int(n[2:].split("_")[0]) for n in Q.QUERIES] == list(range(1, 14))
