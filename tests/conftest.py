import os

import pytest

from punctual.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.sql.session.timeZone": "UTC"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """Sorted list of row tuples in column order."""
    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
