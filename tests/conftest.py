import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A session zone other than the reports' zone: no result may depend on it.
    session = (
        SparkSession.builder.master(f"local[{min(8, os.cpu_count() or 1)}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "Asia/Kolkata")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """table(family, name, rows): a landed table from tuples in schema order, profile first."""
    from pagetrail.schemas import table_schema

    def make(family, name, rows):
        return spark.createDataFrame(rows, table_schema(family, name))

    return make
