import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from runledger.session import get_spark
    # Local mode: the driver JVM is the whole cluster; give it a real heap.
    s = get_spark("local[4]", shuffle_partitions=8, app_name="runledger-tests",
                  extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()
