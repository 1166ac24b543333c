import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsegrid.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="pulsegrid-tests")
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="pulsegrid-test-")
