"""Every registered query against its oracle SQL on the smallest scale.

The whole jobs have tests of their own; `python tools/compare.py` runs all queries at any scale.
"""

import pytest

import __spark_entry__ as entry
from checks import job_queries
from compare import compare, oracle

SF_DIR = entry.SMOKE_DIR
JOBS = {n for n, q in entry.queries().items() if q.__module__ == job_queries.__name__}
NAMES = sorted(set(entry.queries()) - JOBS)


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).columns == ["row_id", "similarity", "title", "source_url", "crawled_at", "text"]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) in (None, "no rows")
