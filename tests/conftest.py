import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vereda.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(root / "shared"),
        "spark.sql.warehouse.dir": str(root / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
