import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from envstream.session import build_session  # noqa: E402

SF = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "envstream-tests",
        shuffle_partitions=4,
        master="local[8]",
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.default.parallelism": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not SF.exists():
        pytest.skip("test tables are not here")
    return str(SF)
