import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.local.dir": tmp, "spark.sql.warehouse.dir": f"{tmp}/warehouse", "spark.checkpoint.dir": f"file://{tmp}/shared", "spark.driver.memory": "6g", "spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for k, v in conf.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
