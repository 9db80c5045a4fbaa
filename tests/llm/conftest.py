import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_edge import EDGE
from salesmill.llm.common import ship

SCHEMA = "doc_id long, text string, fp long, shard string, n_words int, _dedup string"


@pytest.fixture(scope="session")
def spark(spark):
    ship(spark)
    return spark


@pytest.fixture
def make_docs(spark):
    """Documents of (id, text) with more columns whose names clash with those of results."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, 7, "x", 1, "y") for i, t in rows], SCHEMA
        ).repartition(3)

    return make


@pytest.fixture
def edge_docs(make_docs):
    return make_docs(EDGE)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
