import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    return brute.awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Awkward rows with columns whose names clash with those of the operators."""
    clashing = "slice long, fp long, hash long, row string, words string, bucket long"
    extra = (None, 1, 2, "r", None, 3)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{SCHEMA}, {clashing}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
