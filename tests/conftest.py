import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from harrier.session import get_session

    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1k"}
    session = get_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
