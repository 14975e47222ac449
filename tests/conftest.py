import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="tierline-tests", shuffle_partitions=4,
                      extra_conf={"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})   # many short plans: compile less
    yield s
    s.stop()
