import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from curio.session import build_session

    s = build_session("local[4]", 4, **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoint')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
