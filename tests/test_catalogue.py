"""Every registered query against DuckDB on whole tables."""

import pytest

from tableferry.plans.catalogue import ORACLES, QUERIES
from tableferry.plans.workspace import release

from .oracle import SF_DIR, assert_same


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name])
    release(spark)
