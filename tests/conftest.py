import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("firn-tests")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-warehouse-"), "spark.ui.showConsoleProgress": "false",
    }
    session = builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
