"""Helpers of the text operators' tests."""

import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("sample tables are not here")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def odd_docs(spark):
    """NULLs, empty and very long texts, repeated rows, clashing column names."""
    rows = [
        (1, "one two three four five six seven", "s0", "x"), (1, "one two three four five six seven", "s0", "x"), (None, "one two", None, "y"), (2, None, "s1", None),
        (3, "", "s1", "z"), (4, "   \n\t", None, "z"), (5, "long " * 60_000, "s2", "q"), (6, "ünï côdé 😀 mail a@b.cd", "s3", "q"), (None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, text_key string").selectExpr("*", "1 as start", "2 as node", "'n' as places", "3 as score", "4 as fp")
