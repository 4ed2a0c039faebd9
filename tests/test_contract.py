"""Registered queries against their SQL on the smallest tables."""

import importlib.util
import os

import pytest

import __spark_entry__ as entry
from tests.compare import rows_of_spark, rows_of_sql

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 60


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert rows_of_spark(entry.queries()[name](spark, SF)) == rows_of_sql(entry.oracle_sql()[name], SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_packed_query(spark):
    df = entry.queries()["p4_found"](spark, SF)
    assert df.columns == ["field_name", "row_id", "item_pos", "item"] and df.count() > 100


def test_training_data_queries_are_there_only_with_their_package():
    there = importlib.util.find_spec("stemma.llm") is not None
    assert ("p1_found" in entry.queries()) == there
