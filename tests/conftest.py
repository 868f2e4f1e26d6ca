from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from forecourt.session import build_session

    ckpt = tempfile.mkdtemp(prefix="forecourt-test-ckpt-")
    s = build_session("local[*]", 8, app_name="forecourt-tests", extra={
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": ckpt,  # unset in tests, so set our own
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="forecourt-test-")
