"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from checks import adapters
from checks.catalogue import ORACLES, QUERIES

from .compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as driver

    months = driver.entry(spark).collect()
    assert [r.month for r in months] == sorted(r.month for r in months)
    assert sum(r.filings for r in months) > 0


def test_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PIECE_ROWS", 100)
    items = adapters.table(spark, SF_DIR, "lineitem").count()
    assert adapters.index_pages(spark, SF_DIR).rdd.getNumPartitions() == -(-items // 100) > adapters.PIECES


def test_stream_clean_reads_a_folder_of_files(spark, con, tmp_path):
    adapters.table(spark, SF_DIR, "pages").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    assert differences(QUERIES["stream_clean"](spark, str(tmp_path)), con, ORACLES["stream_clean"]) == ""
