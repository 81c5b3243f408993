import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import fixtures  # noqa: E402
from cabrank.operators.clean import clean_trips  # noqa: E402
from cabrank.schema import LOOKUP_SCHEMA, YELLOW  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def small_dir():
    return str(TESTDATA / "sf0.001")


@pytest.fixture
def raw_trips(spark):
    rows = fixtures.with_type(fixtures.KEPT + fixtures.DROPPED, "yellow_taxi")
    return spark.createDataFrame(rows, fixtures.text_schema(fixtures.TRIP_COLUMNS))


@pytest.fixture
def trips(raw_trips):
    return clean_trips(raw_trips, YELLOW.pickup, YELLOW.dropoff)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(fixtures.ZONES, LOOKUP_SCHEMA)
