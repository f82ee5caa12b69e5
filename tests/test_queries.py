"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidemark.catalog import spark_queries
from tidemark.catalog.oracle_queries import ORACLE
from tidemark.catalog.spark_queries import QUERIES
from tests.conftest import SMALL
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, SMALL), con, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["csv_roundtrip", "json_props", "xml_parts"])
def test_raw_files_are_written_by_many_tasks(spark, con, name, monkeypatch):
    """No task writes more than its file's share of the lines, and every file is whole."""
    folders = []
    written = spark_queries.written
    monkeypatch.setattr(spark_queries, "written", lambda df, kind: folders.append(written(df, kind)) or folders[-1])
    monkeypatch.setattr(spark_queries, "FILE_BYTES", 4000, raising=False)
    assert differences(QUERIES[name](spark, SMALL), con, driver.oracle_sql()[name]) == []
    of_file = spark.read.text(folders[0]).groupBy(F.input_file_name()).agg(F.sum(F.length("value"))).collect()
    total = sum(n for _, n in of_file)
    assert len(of_file) > 2 and max(n for _, n in of_file) < total / 2


def test_entry(spark):
    assert driver.entry(spark).count() > 0
