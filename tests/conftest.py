import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlake.session import local_session

    folder = tmp_path_factory.mktemp("shared")
    session = local_session("8", partitions=4, **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a int, b string", [(1, "x")]) -> DataFrame"""

    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    return make
