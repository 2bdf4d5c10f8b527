import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import build_session
    # spark.checkpoint.dir is read from the environment; build_session picks a
    # fresh local folder only when it is unset
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL
