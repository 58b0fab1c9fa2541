"""The flight table: column names, types and the groups the rest of the package uses."""

from __future__ import annotations

from pyspark.sql import types as T

# The on-time flight record, in file order.
FLIGHT_COLUMNS: dict[str, T.DataType] = {
    "Year": T.IntegerType(),
    "Month": T.IntegerType(),
    "DayofMonth": T.IntegerType(),
    "DayOfWeek": T.IntegerType(),
    "DepTime": T.IntegerType(),
    "CRSDepTime": T.IntegerType(),
    "ArrTime": T.IntegerType(),
    "CRSArrTime": T.IntegerType(),
    "UniqueCarrier": T.StringType(),
    "FlightNum": T.IntegerType(),
    "TailNum": T.StringType(),
    "ActualElapsedTime": T.IntegerType(),
    "CRSElapsedTime": T.IntegerType(),
    "AirTime": T.IntegerType(),
    "ArrDelay": T.IntegerType(),
    "DepDelay": T.IntegerType(),
    "Origin": T.StringType(),
    "Dest": T.StringType(),
    "Distance": T.IntegerType(),
    "TaxiIn": T.IntegerType(),
    "TaxiOut": T.IntegerType(),
    "Cancelled": T.IntegerType(),
    "CancellationCode": T.StringType(),
    "Diverted": T.IntegerType(),
    "CarrierDelay": T.IntegerType(),
    "WeatherDelay": T.IntegerType(),
    "NASDelay": T.IntegerType(),
    "SecurityDelay": T.IntegerType(),
    "LateAircraftDelay": T.IntegerType(),
}

FLIGHT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in FLIGHT_COLUMNS.items()])

LABEL = "ArrDelay"
PREDICTION = "prediction"

# Fixed values. Only known after take-off, so unusable as features.
LEAKAGE_COLUMNS = (
    "ArrTime",
    "ActualElapsedTime",
    "AirTime",
    "TaxiIn",
    "Diverted",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
)

# Fixed values. Carry no signal for a flight that took off.
UNINFORMATIVE_COLUMNS = ("Cancelled", "CancellationCode", "TailNum", "FlightNum")

# Fixed values. A usable training row has all of these.
REQUIRED_COLUMNS = (
    "CRSDepTime",
    "CRSArrTime",
    "ArrDelay",
    "Year",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "UniqueCarrier",
    "CRSElapsedTime",
    "DepDelay",
    "Origin",
    "Dest",
    "Distance",
)

# Fixed values. Known when the plane leaves the ground; TaxiOut is handled apart because it is filled.
TAKEOFF_COLUMNS = (
    "Year",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "DepTime",
    "CRSDepTime",
    "CRSArrTime",
    "UniqueCarrier",
    "CRSElapsedTime",
    "ArrDelay",
    "DepDelay",
    "Origin",
    "Dest",
    "Distance",
)

# Fixed values. Text columns whose most frequent values are worth a look.
PROFILE_CATEGORIES = ("UniqueCarrier", "Origin", "Dest", "TailNum", "CancellationCode")

# Fixed values. HHmm columns, each with the column it falls back to when null.
CLOCK_COLUMNS: dict[str, str | None] = {
    "CRSDepTime": None,
    "CRSArrTime": None,
    "TakeOffTime": None,
    "LandingEst": None,
    "DepTime": "CRSDepTime",
}

DEPARTURE = "CRSDepTimestamp"


def numeric_columns() -> list[str]:
    return [n for n, t in FLIGHT_COLUMNS.items() if isinstance(t, T.NumericType)]


def text_columns() -> list[str]:
    return [n for n, t in FLIGHT_COLUMNS.items() if isinstance(t, T.StringType)]
