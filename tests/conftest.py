import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check import duck_session, spark_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session("4", str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return duck_session(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
