from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def _shipped(spark):
    from railmart.llm import common

    common.ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names the steps use themselves."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = " ".join(f"tok{i}" for i in range(120))
    near = base.replace("tok7 ", "other ")
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "b", None), (3, near, "en", None, 5), (4, None, "en", "a", 0), (5, "", None, "b", 0),
        (6, "one two", "de", "a", 7), (7, "one two", None, None, 7), (8, long, "en", "c", 9), (None, "three words here", "en", "a", 1),
        (9, base, "en", "a", 5), (9, base, "en", "a", 5), (10, " \t\n", "en", "a", 3), (11, "ONE two", "de", "a", 7), (12, "日本語 テキスト", "ja", "a", 8),
    ]
    rows = [(*r, k, k % 3, "x") for k, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, node int, key string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
