import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session
    s = local_session("*", 8, checkpoint_dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
                      driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def pipeline(spark):
    from quarry.plans.pipeline import DensePipeline
    return DensePipeline(spark, SF001)
