from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editlume.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
