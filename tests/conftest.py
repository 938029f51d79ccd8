import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a string, b int", (..), (..))``"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
