import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(__file__)), os.path.dirname(__file__)]

from pricewright.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER
