from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tiers.config import Env  # noqa: E402
from tiers.session import local_session  # noqa: E402
from tiers.sources.tables import create_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, driver_memory="4g", app_name="tiers-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tiers-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="tiers-test-")


@pytest.fixture
def env(spark, workdir):
    e = Env(schema=f"t_{uuid.uuid4().hex[:10]}", landing_path=f"{workdir}/landing",
            schema_location=f"{workdir}/warehouse")
    create_schema(spark, e)
    return e


def write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
