import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rateflow.session import get_session
    s = get_session("local[4]", app="rateflow-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster folder: give checkpoints a fresh local one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rateflow-test-ckpt-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
