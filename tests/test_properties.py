"""Properties that hold for any data, on generated frames."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assayer.operators import scoring, tiering
from assayer.operators.scoring import QualitySpec

ROW = st.tuples(
    st.one_of(st.none(), st.integers(-5, 15)),
    st.one_of(st.none(), st.sampled_from(["", "a", "b", "NaN", "zz"])),
    st.one_of(st.none(), st.just(math.nan), st.floats(-10, 10)),
)
RULES = {"n": {"min": 0, "max": 10, "allowed_values": list(range(8))}, "s": {"pattern": "^[ab]$"}}
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def by_hand(rows):
    missing = sum((n is None) + (s is None) + (d is None or math.isnan(d)) for n, s, d in rows)
    broken = sum(
        (n is not None and not 0 <= n <= 10) + (n is not None and n not in range(8)) + (s is not None and s not in ("a", "b"))
        for n, s, _ in rows
    )
    return missing, broken


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=30))
def test_counts_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "n int, s string, d double")
    row = scoring.score(df, QualitySpec(rules=RULES)).first()
    assert (row["missing_cells"], row["violations"]) == by_hand(rows)
    assert 0.0 <= row["completeness"] <= 1.0
    assert row["completeness"] == pytest.approx(1 - row["missing_cells"] / (3 * len(rows)))


@SETTINGS
@given(st.lists(ROW, min_size=2, max_size=30), st.integers(1, 5))
def test_split_and_union_give_the_same_scores(spark, rows, parts):
    spec = QualitySpec(rules=RULES)
    whole = spark.createDataFrame(rows, "n int, s string, d double")
    counted = [
        scoring.count_cells(spark.createDataFrame(rows[i::parts], whole.schema), spec) for i in range(min(parts, len(rows)))
    ]
    union = counted[0]
    for part in counted[1:]:
        union = union.unionByName(part)
    merged = scoring.scores_from_counts(scoring.merge_counts(union), spec, False).first()
    assert merged.asDict() == pytest.approx(scoring.score(whole, spec).first().asDict())


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=20))
def test_an_invalid_schema_never_reaches_silver(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "n int, s string, d double")
    graded = tiering.tier(df, QualitySpec(streaming=True), schema_valid=F.lit(False)).first()
    assert graded["data_classification"] in ("bronze", "rejected")
