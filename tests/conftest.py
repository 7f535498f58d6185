import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tests"))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from larkspur.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"larkspur.scan.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from larkspur.session import drop_scratch
    drop_scratch(s)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF
