import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seamark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def series(spark):
    """(station_id, ts, value) rows at a fixed step; None = missing."""

    def make(values, step=3600, station="a", start=1704067200, column="value"):
        rows = [(station, start + i * step, None if v is None else float(v)) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"station_id string, t bigint, {column} double")
        return df.selectExpr("station_id", "timestamp_seconds(t) AS ts", column)

    return make
