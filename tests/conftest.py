import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session
    wh = tempfile.mkdtemp(prefix="strata-test-wh-")
    s = local_session(2, 4, app="strata-tests",
                      extra={"spark.sql.warehouse.dir": wh, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")
