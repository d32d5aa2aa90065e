import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Uses spark.checkpoint.dir when the session names one; else a private test folder.
    from strata.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    yield spark


@pytest.fixture()
def scratch(spark):
    from strata.session import scratch_path

    return lambda name: scratch_path(spark, name)
