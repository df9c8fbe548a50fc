import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from labelgraph.session import cleanup, local_session, shared_dir

    s = local_session(4, shuffle_partitions=8, app="labelgraph-tests")
    shared_dir(s)
    yield s
    cleanup(s)
    s.stop()
