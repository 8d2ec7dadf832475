import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.harness import duck, make_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("OFF")
    from tidemill.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SMALL)


@pytest.fixture
def tables(spark):
    from tidemill.catalog import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def folder(spark, request):
    """A new shared folder name for one test."""
    from tidemill.session import work_dir

    return work_dir(spark, "t-" + request.node.name.split("[")[0])
