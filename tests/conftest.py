import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aeris.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def _session():
    return build_session("aeris-tests", master="local[4]", shuffle_partitions=4)


def pytest_sessionstart(session):
    _session()  # test files that name columns when they are read need a Spark context


@pytest.fixture(scope="session")
def spark():
    s = _session()
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh(tmp_path):
    return str(tmp_path)
