import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test; left in place afterwards."""
    return tempfile.mkdtemp(prefix="run-test-")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
