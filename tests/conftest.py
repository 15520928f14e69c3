from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tidemark import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="tidemark-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
    ensure_checkpoint_dir(session, scratch)  # only used when the session names none
    yield session


@pytest.fixture()
def scratch() -> str:
    """A fresh scratch folder per test (never cleared)."""
    return tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp")


def payload_frame(spark, payloads: list[str], extra_cols: dict | None = None):
    rows = [(p,) for p in payloads]
    return spark.createDataFrame(rows, "payload string")
