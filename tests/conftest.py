import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from carestar.session import checkpoint_dir, get_session
    s = get_session("local[*]", app="carestar-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


SF = "/root/testdata/sf0.001"
