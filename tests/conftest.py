import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("INNSPARK_DRIVER_MEM", "4g")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from innspark.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8, app_name="innspark-tests")
    yield s


@pytest.fixture(scope="session")
def mart(spark):
    from innspark.plans.registry import Mart
    return Mart(spark, SF_SMALL)


@pytest.fixture()
def tmp_base(spark):
    import uuid
    from innspark.session import scratch_dir
    return scratch_dir(spark, f"test-{uuid.uuid4().hex[:10]}")
