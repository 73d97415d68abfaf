"""One small session for all tests; workers find the package through PYTHONPATH."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from loamline.session import build_session

    session = build_session(
        "tests", "local[4]", **{"spark_sql_shuffle_partitions": "4", "spark_ui_enabled": "false", "spark_ui_showConsoleProgress": "false", "spark_sql_warehouse_dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('checkpoints')}")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)
