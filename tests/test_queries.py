"""Every registered query against its SQL on the smallest data."""

import pytest

from suite import load
from suite.check import compare, connect
from suite.registry import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
load()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, ROOT, name) == ""


def test_only_iterative_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {
        "score_to_table", "train_price_model", "score_batch", "feature_effect", "train_message_classifier",
        "train_segment_trees"}
