import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quadloom.session import local_session

    session = local_session(4, partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def graph(spark):
    from quadloom.sources.tables import Graph

    return Graph(spark, SMALL)
