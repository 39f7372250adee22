import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pulsewatch.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest test tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ts():
    """Timestamp from ISO text."""
    return dt.datetime.fromisoformat


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))

    return collect
