import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tidewater-test-ckpt-")
    s = build_session("local[4]", app="tidewater-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    from tidewater.session import scratch_dir
    return lambda name: scratch_dir(spark, name)
