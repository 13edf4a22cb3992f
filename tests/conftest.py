import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pagetables.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, 8, **{"spark.checkpoint.dir": shared, "spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
