import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from herald.session import build_session
    s = build_session("local[4]", app="herald-tests", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()
