import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from queuecraft.session import local_session, tuned  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return tuned(local_session("4", 4))


@pytest.fixture(scope="session")
def sf():
    return SF
