import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark():
    from loomsift.session import get_session

    return get_session("tests", cpus=8)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
