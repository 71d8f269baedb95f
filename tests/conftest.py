import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from check_oracle import session

    return session()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
