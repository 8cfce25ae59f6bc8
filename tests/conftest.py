import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from homestead.session import build_session, remove_scratch
    s = build_session("local[4]", app="homestead-tests", shuffle_partitions=8,
                      extra={"spark.sql.sources.parallelPartitionDiscovery.parallelism": "8"})
    yield s
    remove_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def con01():
    from parity import SF01, duck
    return duck(SF01)
