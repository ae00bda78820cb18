import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def days():
    def make(n, start="2010-01-01"):
        first = datetime.date.fromisoformat(start)
        return [first + datetime.timedelta(days=i) for i in range(n)]

    return make


@pytest.fixture
def panel(spark, days):
    """(series_key, date, x) from {key: values}; None stays null."""

    def make(series, start="2010-01-01", schema="series_key string, date date, x double"):
        rows = [
            (k, d, None if v is None else float(v)) for k, values in series.items() for d, v in zip(days(len(values), start), values)
        ]
        return spark.createDataFrame(rows, schema)

    return make
