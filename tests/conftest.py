from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import get_spark

    s = get_spark("tillroll-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path_factory):
    return tmp_path_factory.mktemp("run")
