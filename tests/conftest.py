import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from latebird.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA  # noqa: E402
from latebird.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", app="latebird-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def flights(spark, sf_dir):
    from latebird.catalog.flights import flights as read

    return read(spark, sf_dir)


@pytest.fixture(scope="session")
def make_flights(spark):
    """Flight rows from dicts; what is not given is a plain valid value."""
    plain = {
        "Year": 2006,
        "Month": 12,
        "DayofMonth": 31,
        "DayOfWeek": 7,
        "DepTime": 1000,
        "CRSDepTime": 1000,
        "ArrTime": 1130,
        "CRSArrTime": 1130,
        "UniqueCarrier": "AA",
        "FlightNum": 1,
        "TailNum": "N1",
        "ActualElapsedTime": 90,
        "CRSElapsedTime": 90,
        "AirTime": 70,
        "ArrDelay": 5,
        "DepDelay": 0,
        "Origin": "JFK",
        "Dest": "LAX",
        "Distance": 500,
        "TaxiIn": 5,
        "TaxiOut": 10,
        "Cancelled": 0,
        "Diverted": 0,
    }

    def make(*rows):
        records = [tuple({**plain, **row}.get(c) for c in FLIGHT_COLUMNS) for row in rows]
        return spark.createDataFrame(records, FLIGHT_SCHEMA)

    return make
