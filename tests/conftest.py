import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    builder = SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]").appName("tests")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"{folder}/checkpoint", "spark.local.dir": f"{folder}/local",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    return connection
