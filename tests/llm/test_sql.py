"""The operators that SQL can express, against their SQL."""

import pytest

from changeweir.llm.queries import ORACLES, QUERIES
from tools.check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    note, _, ok = compare(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, note
