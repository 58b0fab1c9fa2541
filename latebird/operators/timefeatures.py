"""Clock-time features of a flight."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.functions import clock
from latebird.schema import CLOCK_COLUMNS, DEPARTURE


def with_departure(df: DataFrame, parsed: bool = False) -> DataFrame:
    """Add the scheduled departure timestamp."""
    text = clock.departure_parsed() if parsed else clock.departure()
    return df.withColumn(DEPARTURE, F.expr(text))


def takeoff_expression(null_as_zero: bool = False) -> str:
    """HHmm of departure plus delay plus taxi time."""
    minutes = clock.minutes_total(["DepDelay", "TaxiOut"], null_as_zero)
    return clock.hhmm_of(clock.shifted(DEPARTURE, minutes))


def landing_expression(after_takeoff: bool = True, null_as_zero: bool = False) -> str:
    """HHmm of the expected landing: take-off plus the scheduled flight time,
    or (`after_takeoff=False`) scheduled departure plus that time, null as 0."""
    if after_takeoff:
        minutes = clock.minutes_total(["DepDelay", "TaxiOut", "CRSElapsedTime"], null_as_zero)
    else:
        minutes = clock.minutes_total(["CRSElapsedTime"], null_as_zero=True)
    return clock.hhmm_of(clock.shifted(DEPARTURE, minutes))


def with_takeoff_time(df: DataFrame, null_as_zero: bool = False) -> DataFrame:
    return df.withColumn("TakeOffTime", F.expr(takeoff_expression(null_as_zero)))


def with_landing_estimate(
    df: DataFrame, after_takeoff: bool = True, null_as_zero: bool = False
) -> DataFrame:
    return df.withColumn("LandingEst", F.expr(landing_expression(after_takeoff, null_as_zero)))


def split_expressions(
    columns: Mapping[str, str | None] = CLOCK_COLUMNS,
) -> dict[str, str]:
    """Hour and minute of HHmm columns, by output name."""
    parts: dict[str, str] = {}
    for name, fallback in columns.items():
        value = f"coalesce({name}, {fallback})" if fallback else name
        parts[f"{name}Hour"] = clock.hour_of(value)
        parts[f"{name}Minute"] = clock.minute_of(value)
    return parts


def split_clock_columns(
    df: DataFrame, columns: Mapping[str, str | None] = CLOCK_COLUMNS
) -> DataFrame:
    return df.withColumns({n: F.expr(e) for n, e in split_expressions(columns).items()})


def drop_clock_columns(df: DataFrame) -> DataFrame:
    return df.drop(*CLOCK_COLUMNS, DEPARTURE)
