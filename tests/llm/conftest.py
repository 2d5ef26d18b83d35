import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

from brute import TEXTS


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empties, long words, repeated rows, and columns with names the operators use."""
    rows = [(i, t, "src" if i % 2 else None, "en" if i % 3 else None, None if t is None else len(t), 1, "x", 2) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "text without an id " * 3, None, None, None, 1, "y", 2)]
    names = "doc_id bigint, text string, source string, lang string, n_chars bigint, kept int, contamination string, s int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i == 5), "extra") for i in range(11)] + [(None, None, None, None), (3, None, 1, None)],
                                 "doc_id bigint, quality int, toxic int, text string")


@pytest.fixture(scope="session")
def small():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    return folder


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
