from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from ledgerlight.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))  # catalog tables go here
    shared = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests", {"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    return session
