import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trackcast.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app_name="trackcast-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from trackcast.sources.fixtures import SourceTables

    return SourceTables(spark, SF_SMALL)


@pytest.fixture()
def scratch(spark):
    from trackcast.session import scratch_path

    def make(name: str) -> str:
        return scratch_path(spark, name)

    return make
