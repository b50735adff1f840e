import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def frame(spark):
    """(rows, ddl) -> DataFrame over several partitions."""
    def make(rows, ddl, parts=3):
        return spark.createDataFrame(rows, ddl).repartition(parts)
    return make
