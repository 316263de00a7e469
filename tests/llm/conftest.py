import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from textlab.session import get_spark
    return get_spark("local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def documents(spark):
    """Schema of the documents table, with a column of a clashing name."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, s, 7) for i, t, s in rows], "doc_id long, text string, source string, n long")
    return make
