"""Registered queries against their SQL on the smallest tables; ``check.py`` runs them all."""

import inspect

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
CHECKED = (
    "strip_mail pad_batch drop_rare build_dictionary extend_vocabulary tfidf_transform rank_all "
    "most_similar_documents similarity_join skipgram_pairs analogy_accuracy code_table next_word_windows "
    "vectorize_windows pool_attention classification_report read_word_stream matrix_market_bow stream_score"
).split()


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    assert len(got)
    assert check.difference(got, duck.execute(oracle_sql()[name]).df()) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() == 200


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert all(len(inspect.signature(f).parameters) == 2 for f in queries().values())
