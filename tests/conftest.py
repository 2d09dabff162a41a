import os
import sys
import uuid

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("TZ", "UTC")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from tidemark.sources.store import ArchiveStore

    return ArchiveStore(spark, f"file://{tmp_path}/{uuid.uuid4().hex[:8]}")


@pytest.fixture
def sf_dir():
    return DATA
