"""Every registered query against its SQL in an independent engine."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql
from changeweir.plans.registry import QUERIES
from tools.check_oracles import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    note, _, ok = compare(spark, con, SF_DIR, name, QUERIES[name], oracle_sql().get(name))
    assert ok, note


def test_only_undetermined_results_lack_sql():
    assert set(QUERIES) - set(oracle_sql()) == {"lake_files"}


def test_entry(spark):
    assert entry(spark).count() > 0
