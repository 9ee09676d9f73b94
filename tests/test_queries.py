"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from reviewlib.plans.oracles import ORACLES
from reviewlib.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# Iterative training and clustering, and cuts chosen by a search over a histogram, whose results SQL
# cannot state; each is tested against a plain version or its stated bounds in its own tests
# (test_sequence, test_communities, test_embeddings, test_grouped_split, test_raters, test_dense,
# test_topics).
ITERATIVE = {"train_sequence_metrics", "review_clusters", "word_embeddings", "grouped_split", "weak_labels",
             "spam_authors", "review_topics"}


def test_every_query_has_sql():
    assert set(QUERIES) - ITERATIVE == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name)) is None
