import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sampleloom.session import build_session
    from sampleloom.streaming.state import STATE_CONF

    s = build_session("tests", "local[8]", 8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8", **STATE_CONF})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
