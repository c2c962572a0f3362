"""The registered queries against SQL where there is some."""

import pytest

from tableferry.llm.queries import ORACLES, QUERIES

from ..oracle import SF_DIR, assert_same


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name]) > 0


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", ["op4_url_filter", "op5_packing", "op6_quality_ranker", "op8_token_output", "op10_license_scan"])
def test_other_queries_have_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
