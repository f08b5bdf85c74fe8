import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabulark.session import checkpoint_root, local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tabulark-tests")
    checkpoint_root(s)  # unset in tests: a local folder of our own
    yield s
    s.stop()
