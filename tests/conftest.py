from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="holdfast-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def customers(spark, small):
    from holdfast.plans import catalog

    table = catalog.customers(spark, small).persist()
    yield table
    table.unpersist()


@pytest.fixture(scope="session")
def fitted(spark, small):
    from holdfast.plans import catalog

    return catalog.fitted(spark, small)
