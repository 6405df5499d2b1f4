"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from assayer.plans import load_queries
from tests.oracle import differences

QUERIES, ORACLES = load_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    assert differences(spark, duck, sf_dir, name) == []


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(ORACLES) == set(QUERIES)
