import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterflow.session import build_session, checkpoint_root
    s = build_session("local[4]", 4, app="meterflow-tests")
    checkpoint_root(s)  # sets a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
