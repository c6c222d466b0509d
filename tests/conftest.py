from __future__ import annotations

import datetime as dt

import pytest

from tablelens.session import build_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def invoices(spark):
    rows = [
        ("Smith", "A", 500, dt.datetime(2025, 1, 15)),
        ("Smith", "A", 300, dt.datetime(2025, 2, 20)),
        ("Jones", "B", 200, dt.datetime(2025, 1, 10)),
        ("Jones", "B", 400, dt.datetime(2025, 3, 5)),
        ("Smith", "A", 100, dt.datetime(2025, 3, 15)),
    ]
    return spark.createDataFrame(
        rows, "Technician string, Region string, Amount bigint, ServiceDate timestamp_ntz"
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
