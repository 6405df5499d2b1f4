from __future__ import annotations

import pytest

LONG = " ".join(f"word{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and repeated ids, null, empty, blank, very long, equal texts, and columns named as the operators' own."""
    rows = [
        (1, "one two three four five six seven eight nine ten.\nShort line."), (1, "one two three four five six seven eight nine ten.\nShort line."),
        (2, "one two three four five six seven eight nine ten.\nOther line here."), (3, None), (4, ""), (5, " \n\t \n"), (6, LONG), (7, LONG + " end"),
        (None, "a text without an id"), (None, "a text without an id"), (None, None), (8, "你好 世界 ñandú été\x85x y"), (9, "12345 !!! ###"), (1, "another text of the same id"),
        (10, "tie " * 40), (11, "tie " * 40),
    ]
    rows = [(i, t, "en" if i is None or i % 2 else None, "s", 0, 1, "x", "y", 2, 3.0) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, mark string, word string, class int, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (6, 0, 1), (99, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels", "pages", "benchmark")}
