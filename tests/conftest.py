import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("weatherloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of(capsys):
    """The formatted physical plan as text."""

    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


DAILY = (
    "ID string, DATE string, ELEMENT string, VALUE double, MEASUREMENT_FLAG string, "
    "QUALITY_FLAG string, SOURCE_FLAG string, OBSERVATION_TIME string"
)


@pytest.fixture
def daily_of(spark):
    """Observations from (ID, DATE, ELEMENT, VALUE[, QUALITY_FLAG]) tuples."""

    def build(rows):
        full = [
            (r[0], r[1], r[2], r[3], None, r[4] if len(r) > 4 else None, "S", "0630") for r in rows
        ]
        return spark.createDataFrame(full, DAILY)

    return build


@pytest.fixture
def rows_of():
    def rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return rows
