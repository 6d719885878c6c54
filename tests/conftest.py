import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from suite.check import session

    s = session(cores=4, memory="6g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def claims(spark, sf):
    """Claims of the smallest data set, stored once."""
    from claimsight.session import materialize
    from suite.fixture import claims as view

    return materialize(view(spark, sf), "test-claims")
