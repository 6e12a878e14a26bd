from __future__ import annotations

import pytest

from salescope.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


COLUMNS = (
    "model string, year double, region string, color string, fuel_type string, transmission string, "
    "engine_size_l double, mileage_km double, price_usd double, sales_volume double"
)
DEFAULT = {
    "model": "A",
    "year": 2020.0,
    "region": "North",
    "color": "red",
    "fuel_type": "Petrol",
    "transmission": "Manual",
    "engine_size_l": 2.0,
    "mileage_km": 40000.0,
    "price_usd": 30000.0,
    "sales_volume": 10.0,
}


@pytest.fixture(scope="session")
def make(spark):
    """A sales frame from rows that name only what differs from the default row."""

    def build(*rows, **shared):
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        data = [tuple({**DEFAULT, **shared, **row}[n] for n in names) for row in rows]
        return spark.createDataFrame(data, COLUMNS)

    return build


def records(df):
    return [r.asDict() for r in df.collect()]
