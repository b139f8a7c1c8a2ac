import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, app="wardlens-tests", **{"spark.checkpoint.dir": str(folder)}
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from a schema text and tuples."""

    def build(schema, data):
        return spark.createDataFrame(data, schema)

    return build
