import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"
