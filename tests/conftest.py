import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from keyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, app="keyloom-tests", **{"spark.default.parallelism": "2"})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path_factory):
    """A new folder per test."""
    return str(tmp_path_factory.mktemp("run"))


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one text value."""

    def evaluate(expression, value, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("x")).first()["x"]

    return evaluate
