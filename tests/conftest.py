from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

KEYWORDS = ("Exception", "Error", "timeout", "fail", "OOM", "connection refused", "deadlock")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lines_of(spark):
    """A DataFrame of raw lines, numbered, all in one file."""

    def make(*raw: str | None, source_file: str = "app.log"):
        rows = [(line, source_file, i) for i, line in enumerate(raw, start=1)]
        return spark.createDataFrame(rows, "raw string, source_file string, line_number bigint")

    return make
