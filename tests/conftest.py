from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CUT = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def split(spark):
    """Leave small shuffle partitions apart, so that keys are cut into many chunks on small fixtures."""
    kept = {k: spark.conf.get(k) for k in CUT}
    for k, v in CUT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)
