import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roundstats.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, app="roundstats-tests")
    yield s


@pytest.fixture()
def tmpdir_text(tmp_path):
    def write(name, lines):
        p = tmp_path / name
        p.write_text(lines)
        return str(p)
    return write
