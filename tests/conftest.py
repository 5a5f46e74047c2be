import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_limits(monkeypatch):
    """Bounds so low that every operator takes the way meant for big groups and tables."""
    from feedmill.operators.limits import LIMITS

    monkeypatch.setattr(LIMITS, "group_max_rows", 3)
    monkeypatch.setattr(LIMITS, "list_max_items", 3)
    monkeypatch.setattr(LIMITS, "hot_min_rows", 5)
    monkeypatch.setattr(LIMITS, "hot_share", 0.002)
    monkeypatch.setattr(LIMITS, "hot_cell_rows", 10)
    monkeypatch.setattr(LIMITS, "broadcast_max_rows", 20)
    return LIMITS
