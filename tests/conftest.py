import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def frame(spark):
    """Rows of a small fixture table; dates and timestamps are written as text."""

    def make(rows, schema):
        import re

        raw = re.sub(r"\b(date|timestamp)\b(?=\s*(,|$))", "string", schema)
        df = spark.createDataFrame(rows, raw)
        for part in re.split(r",(?![^<]*>)", schema):
            name, kind = part.strip().split(" ", 1)
            if kind in ("date", "timestamp"):
                df = df.withColumn(name, df[name].cast(kind))
        return df

    return make
