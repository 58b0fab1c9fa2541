"""Clock edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from latebird.functions import clock
from latebird.operators import timefeatures
from latebird.plans import stages


def _timed(df):
    df = timefeatures.with_departure(df)
    return timefeatures.with_landing_estimate(timefeatures.with_takeoff_time(df))


def _one(df, column):
    return df.select(column).first()[0]


@pytest.mark.parametrize("parsed", [False, True])
def test_2400_is_the_next_midnight(make_flights, parsed):
    df = timefeatures.with_departure(make_flights({"CRSDepTime": 2400}), parsed=parsed)
    assert _one(df, "CRSDepTimestamp") == datetime(2007, 1, 1)


@pytest.mark.parametrize("parsed", [False, True])
@pytest.mark.parametrize(
    "row", [{"CRSDepTime": 1275}, {"CRSDepTime": 2430}, {"Month": 2, "DayofMonth": 30}]
)
def test_impossible_departure_is_null(make_flights, row, parsed):
    df = timefeatures.with_departure(make_flights(row), parsed=parsed)
    assert _one(df, "CRSDepTimestamp") is None


@pytest.mark.parametrize(
    "row, takeoff",
    [
        ({"CRSDepTime": 2350, "DepDelay": 30, "TaxiOut": 40}, 100),
        ({"CRSDepTime": 5, "DepDelay": -10, "TaxiOut": 20}, 15),
        ({"CRSDepTime": 5, "DepDelay": -10, "TaxiOut": 0}, 2355),
        ({"DepDelay": None}, None),
        ({"TaxiOut": None}, None),
    ],
)
def test_takeoff_time(make_flights, row, takeoff):
    assert _one(_timed(make_flights(row)), "TakeOffTime") == takeoff


def test_null_minutes_can_count_as_zero(make_flights):
    df = timefeatures.with_departure(make_flights({"DepDelay": None, "TaxiOut": None}))
    assert _one(timefeatures.with_takeoff_time(df, null_as_zero=True), "TakeOffTime") == 1000


def test_landing_after_takeoff_and_from_schedule(make_flights):
    df = timefeatures.with_departure(
        make_flights({"DepDelay": 20, "TaxiOut": 10, "CRSElapsedTime": 60})
    )
    assert _one(timefeatures.with_landing_estimate(df), "LandingEst") == 1130
    assert _one(timefeatures.with_landing_estimate(df, after_takeoff=False), "LandingEst") == 1100
    unknown = timefeatures.with_departure(make_flights({"CRSElapsedTime": None}))
    assert (
        _one(timefeatures.with_landing_estimate(unknown, after_takeoff=False), "LandingEst") == 1000
    )


def test_split_keeps_hour_24_and_falls_back_for_departure(make_flights):
    df = timefeatures.split_clock_columns(
        _timed(make_flights({"CRSDepTime": 2400, "DepTime": None}))
    )
    row = df.first()
    assert (row["CRSDepTimeHour"], row["CRSDepTimeMinute"]) == (24, 0)
    assert (row["DepTimeHour"], row["DepTimeMinute"]) == (24, 0)
    dropped = timefeatures.drop_clock_columns(df)
    assert not {"CRSDepTime", "DepTime", "CRSDepTimestamp", "TakeOffTime"} & set(dropped.columns)


def test_minute_below_60_and_hour_at_most_24(flights):
    df = timefeatures.split_clock_columns(_timed(flights))
    hours = [c for c in df.columns if c.endswith("Hour")]
    minutes = [c for c in df.columns if c.endswith("Minute")]
    bad = [F.col(c) > 24 for c in hours] + [F.col(c) > 59 for c in minutes]
    assert df.where(F.greatest(*[F.coalesce(b.cast("int"), F.lit(0)) for b in bad]) == 1).isEmpty()


def test_built_and_parsed_departures_agree(flights):
    both = timefeatures.with_departure(flights).withColumn(
        "parsed", F.expr(clock.departure_parsed())
    )
    assert both.where(~F.col("parsed").eqNullSafe(F.col("CRSDepTimestamp"))).isEmpty()


def test_arithmetic_clock_equals_formatted_clock(flights):
    shifted = clock.shifted("CRSDepTimestamp", clock.minutes_total(["DepDelay", "TaxiOut"]))
    both = _timed(flights).withColumn("text", F.expr(clock.clock_text(shifted)).cast("int"))
    assert both.where(~F.col("text").eqNullSafe(F.col("TakeOffTime"))).isEmpty()


def test_clock_does_not_depend_on_the_session_zone(spark, make_flights):
    # 2006-04-02 02:30 does not exist in New York.
    df = make_flights({"Month": 4, "DayofMonth": 2, "CRSDepTime": 230, "TaxiOut": 10})
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _one(_timed(df), "TakeOffTime") == 240
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_takeoff_uses_the_incoming_taxi_time_not_the_filled_one(make_flights):
    df = make_flights(*[{"TaxiOut": t} for t in (5, 20, 40)])
    out = stages.time_stage(taxi_out=stages.batch_median()).transform(df)
    rows = sorted((r["TakeOffTime"], r["TaxiOut"]) for r in out.collect())
    assert rows == [(1005, 20), (1020, 20), (1040, 20)]


def test_stages_equal_operators(flights):
    staged = stages.time_stage().transform(flights)
    direct = _timed(flights).select(staged.columns)
    assert staged.exceptAll(direct).isEmpty() and direct.exceptAll(staged).isEmpty()
    split = stages.drop_clock_stage().transform(stages.split_clock_stage().transform(staged))
    expected = timefeatures.drop_clock_columns(timefeatures.split_clock_columns(direct))
    assert split.columns == expected.columns
    assert split.exceptAll(expected).isEmpty()


def test_departure_is_built_once(make_flights):
    """The same as a branch for 2400 and one for the rest, each building a timestamp,
    which made the scoring method too long for the JVM to compile."""
    times = [0, 59, 100, 2359, 2360, 2400, 2401, 2500, -5, -100, -2400, None]
    days = [(2006, 12, 31), (2007, 2, 29), (None, 1, 1)]
    df = make_flights(
        *[{"CRSDepTime": t, "Year": y, "Month": m, "DayofMonth": d} for t in times for y, m, d in days]
    )
    at = "try_make_timestamp_ntz(Year, Month, DayofMonth, {}, {}, 0)"
    branches = (
        f"CASE WHEN CRSDepTime = 2400 THEN {at.format(0, 0)} + INTERVAL 1 DAY ELSE "
        f"{at.format('CAST(floor(CRSDepTime / 100) AS INT)', 'CAST(CRSDepTime % 100 AS INT)')} END"
    )
    got = df.select(F.expr(clock.departure()).alias("own"), F.expr(branches).alias("wanted")).collect()
    assert [r["own"] for r in got] == [r["wanted"] for r in got]
    assert sum(r["own"] is not None for r in got) == 5
    assert clock.departure().count("try_make_timestamp_ntz") == 1
