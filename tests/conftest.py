import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


def _start():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Not UTC on purpose: nothing may depend on the session zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def pytest_configure(config):
    # Before collection: test modules build columns when they are imported.
    _start()


@pytest.fixture(scope="session")
def spark():
    session = _start()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def manifest(spark):
    from traceframe.sources import sample

    return sample.sample_manifest(spark)


@pytest.fixture(scope="session")
def raw(spark, tmp_path_factory):
    """Sample records, stored once."""
    from traceframe.sources import sample
    from traceframe.sources.records import read_events

    path = str(tmp_path_factory.mktemp("raw") / "events")
    sample.raw_events(sample.read_source(spark, SF_DIR)).write.parquet(path)
    return read_events(spark, path)
