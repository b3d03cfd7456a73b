from __future__ import annotations

import datetime as dt
import os

import pytest

from paysignal.schemas import BRONZE_SCHEMA
from paysignal.session import build_session

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": os.path.join("/tmp", f"paysignal-warehouse-{os.getpid()}"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALLEST):
        pytest.skip("test tables are not there")
    return SMALLEST


def at(second: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)


DEFAULT_PAYMENT = {
    "event_time": "2024-01-01T00:00:00+00:00", "payment_id": "p1", "payment_group_id": "g1", "customer_id": "u1",
    "card_id": "c1", "merchant_id": "m1", "device_id": "d1", "ip": "10.0.0.1", "country": "ES", "amount": 10.0,
    "currency": "EUR", "status": "approved", "mcc": "5411", "attempt_number": 1, "scenario": "normal",
    "ingestion_ts": at(5),
}


@pytest.fixture
def bronze(spark):
    """Bronze rows from partial dictionaries; ``second`` sets the event time."""

    def make(rows: list[dict]):
        full = []
        for i, row in enumerate(rows):
            row = dict(row)
            values = {**DEFAULT_PAYMENT, "payment_id": f"p{i}"}
            if "second" in row:
                values["event_time"] = at(row.pop("second")).strftime("%Y-%m-%dT%H:%M:%S+00:00")
            values.update(row)
            full.append(tuple(values[f.name] for f in BRONZE_SCHEMA))
        return spark.createDataFrame(full, BRONZE_SCHEMA)

    return make
