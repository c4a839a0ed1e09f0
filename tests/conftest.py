from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TALKTALLY_TEST_DATA", "/root/testdata/sf0.001")


def make_session() -> SparkSession:
    # A zone with daylight saving, so that any dependence on the session zone shows.
    session = (
        SparkSession.builder.master("local[4]")
        .appName("talktally-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="talktally-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    return make_session()
