import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siltstone.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1"})
    yield made
    made.stop()
