import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from paneltide.session import get_spark
    s = get_spark("local[4]", app="paneltide-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
