from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1])]

from recordtrust.session import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        configured(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = {}

    def change(**options: str) -> None:
        for name, value in options.items():
            key = "spark.recordtrust." + name
            changed[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, old in changed.items():
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
