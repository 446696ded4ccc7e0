import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fieldlens.session import get_session

    s = get_session("local[4]", app="fieldlens-tests",
                    **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldlens-test-ckpt-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
