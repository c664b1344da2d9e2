import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from mentionmill.session import build

    session = build(
        "tests", "local[2]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.driver.host": "127.0.0.1"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
