"""Every registered query against its SQL twin on the small test folder."""

from pathlib import Path

import pytest

from oracle import compare
from registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert name in SQL, "every registered query has a SQL twin"
    rows, wrong, _ = compare(spark, QUERIES[name], SQL[name], SF_DIR)
    assert wrong is None, wrong
