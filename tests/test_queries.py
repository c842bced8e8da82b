"""Every registered query against its check SQL, on the smallest data."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points
from conftest import SMALL
from martweave.catalog import all_checks, all_queries

NAMES = list(all_queries())
UNCHECKED = {"iforest_scores", "iforest_report", "iforest_mean_scores"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_only_named_queries_lack_a_check():
    assert set(NAMES) - set(all_checks()) == UNCHECKED
    assert set(all_checks()) <= set(NAMES)
    assert set(NAMES) <= set(entry_points.queries())


def test_entry_runs(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    _, count, text = compare(spark, duck, SMALL, name)
    assert not text
    assert count >= 0
