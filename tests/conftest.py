import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from driftmark.session import local_session

    session = local_session("tests", 8, 2, spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(path).exists():
        pytest.skip("no test tables")
    return path
