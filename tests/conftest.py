import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievework.session import apply_job_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="sievework-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return apply_job_settings(session)


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("t"))
