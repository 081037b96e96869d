import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyproof-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    """Folder of the supplied tables at the given scale."""
    return lambda sf: os.path.join(os.environ.get("TESTDATA", "/root/testdata"), f"sf{sf}")
