"""Queries against their SQL, and against plain versions where SQL cannot say them."""

from __future__ import annotations

import pytest

from assayer.llm.queries import ORACLES, QUERIES
from tests.oracle import DATA, connect, rows_of


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("size", ["sf0.01"])
def test_same_rows_as_sql(spark, name, size):
    actual = rows_of(QUERIES[name](spark, f"{DATA}/{size}").toArrow())
    expected = rows_of(connect(f"{DATA}/{size}").execute(ORACLES[name]).to_arrow_table())
    assert actual == expected


def test_queries_are_registered_with_the_pipeline():
    import __spark_entry__

    assert [n for n in __spark_entry__.queries() if n.startswith("op")] == list(QUERIES)
    assert "pipeline" in __spark_entry__.queries()
    assert len(QUERIES) == 13


def test_only_given_queries_have_python(spark, sf_dir):
    plan = QUERIES["op9_line_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
