import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recunify.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from recunify.checks.compare import duck
    return duck(SF01)
