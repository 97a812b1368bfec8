import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# same names as in the parent folder's conftest, for modules that import either
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of the given texts (id = place) with clashing extra columns."""
    def make(texts, first=0):
        from helpers_llm import DOCS
        rows = [(first + i, t, "en", "src0", None, 7, 8) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS + ", id long, tag long").repartition(3)
    return make
