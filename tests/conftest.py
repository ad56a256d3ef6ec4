import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeride.session import build_session, checkpoint_root
    s = build_session("lakeride-tests", "local[*]", 8)
    checkpoint_root(s)  # keeps the configured folder; chooses one only if unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf0001():
    return SF0001
