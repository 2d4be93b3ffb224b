import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__session__timeZone="UTC",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column_of(spark):
    """Apply a Column function to texts: `column_of(f, ["a", None])`."""
    def apply(function, values):
        from pyspark.sql import functions as F
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]
    return apply
