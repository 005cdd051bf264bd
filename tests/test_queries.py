"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck_connection
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
# Whole loads are covered by test_tables.py; range_status asks for a range of larger tables.
ELSEWHERE = {
    "historical_state", "historical_rows", "maintain_state", "auto_maintain_state",
    "stream_ingest_state", "stream_ingest_rows", "append_versioned", "delete_range",
    "replace_ranges", "expire_live", "compact_table", "range_status", "stream_bad_ranges", "historical_files",
    "historical_bad_rows",
}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["dataset", "gap_start", "gap_end"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ELSEWHERE])
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) == ""
