import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_data import ODD_TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, very long and repeated rows, and extra columns whose names clash with those of the operators."""
    long = " ".join(f"word{i % 997} of{i % 13}" for i in range(12_000))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100, long, "en", None, len(long)), (101, long, None, "s", len(long)),
             (None, "null id text here", None, None, None), (None, None, None, None, None),
             (5, ODD_TEXTS[5], "en", "s", 1), (5, ODD_TEXTS[5], "en", "s", 1)]
    names = ("doc_id long, text string, lang string, source string, n_chars long, key long, size string, n int, "
             "row string, words string, kept string, shard int, spans string, _key string")
    return spark.createDataFrame([r + (1, "a", 2, "b", "c", "d", 3, "e", "f") for r in rows], names).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
