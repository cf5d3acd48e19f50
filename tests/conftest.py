import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.plans.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app="ledgerlake-tests", checkpoint_dir=tempfile.mkdtemp(prefix="ledgerlake-test-checkpoint-"))
    yield s
    s.stop()
