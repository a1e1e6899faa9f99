import os
import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vitals.session import build_session  # noqa: E402

SF_DIR = os.environ.get("VITALS_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "vitals-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tmp_path(tmp_path):
    """A folder never used before, as stream checkpoints are kept by target."""
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    return folder


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
