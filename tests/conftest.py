import os
import sys

import pytest
from pyspark.sql import SparkSession

from .ledger_source import LedgerSource

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Spark's Python workers import the test source from wherever the tests are started
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8,4]")  # failed tasks are retried
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    session.dataSource.register(LedgerSource)
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    from tableferry.plans.workspace import new_database, release

    yield new_database(spark)
    release(spark)


@pytest.fixture
def write_source(spark, tmp_path):
    """Write rows as parquet and return the path, as a source table."""

    def write(rows, schema, name="t"):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return path

    return write
