import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from seisflow.session import build_session

    s = build_session(app="seisflow-tests", master="local[4]", shuffle_partitions=4,
                      conf={"spark.ui.showConsoleProgress": "false",
                            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="seisflow-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="seisflow-test-")
