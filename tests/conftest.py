import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # One session runs all tests. The driver keeps the plans of finished queries, 1000 by default, some of
        # which are thousands of nodes; with the default memory of 1 GB that ended the process half-way.
        .config("spark.driver.memory", "4g")
        .config("spark.sql.ui.retainedExecutions", "10")
        .config("spark.ui.retainedJobs", "20")
        .config("spark.ui.retainedStages", "20")
        .config("spark.ui.retainedTasks", "200")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
