import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from platewise.session import build_session
    ckpt = tempfile.mkdtemp(prefix="platewise-tests-")
    s = build_session("local[*]", 8, "platewise-tests", {"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    yield s


@pytest.fixture()
def scratch(spark):
    from platewise.session import storage_root
    return tempfile.mkdtemp(prefix="t-", dir=storage_root(spark))
