"""Queries: profiling, filters, projections, clock times, medians, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.catalog import query
from latebird.catalog.flights import (
    ARITHMETIC_PREDICTION,
    CLEAN,
    DEPARTURE_SQL,
    DEPARTURE_TEXT,
    TRAIN_CONDITION,
    check_sql,
    flights,
    hhmm_sql,
)
from latebird.functions import clock
from latebird.operators import cleaning, leaderboard, median, metrics, profile, sketch, timefeatures
from latebird.plans import stages
from latebird.schema import (
    DEPARTURE,
    FLIGHT_COLUMNS,
    LABEL,
    LEAKAGE_COLUMNS,
    PROFILE_CATEGORIES,
    REQUIRED_COLUMNS,
    TAKEOFF_COLUMNS,
    UNINFORMATIVE_COLUMNS,
    numeric_columns,
    text_columns,
)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: sums of doubles depend on the order of the rows."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- Profiling -------------------------------------------------------------


@query(
    "null_counts",
    check_sql(
        "SELECT "
        + ", ".join(f"count(*) - count({c}) AS {c}" for c in FLIGHT_COLUMNS)
        + " FROM flights"
    ),
)
def null_counts(spark, sf_dir):
    return profile.null_counts(flights(spark, sf_dir))


@query(
    "describe_numeric",
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS \"min\", "
            f"CAST(max({c}) AS DOUBLE) AS \"max\" FROM flights"
            for c in numeric_columns()
        )
    ),
)
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(flights(spark, sf_dir)))


@query(
    "describe_text",
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", min({c}) AS \"min\", "
            f"max({c}) AS \"max\" FROM flights"
            for c in text_columns()
        )
    ),
)
def describe_text(spark, sf_dir):
    return profile.describe_text(flights(spark, sf_dir))


@query(
    "category_counts",
    check_sql('SELECT Origin, count(*) AS "count" FROM flights GROUP BY Origin'),
)
def category_counts(spark, sf_dir):
    return profile.category_counts(flights(spark, sf_dir), "Origin")


@query(
    "category_topk",
    check_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST(r AS INT) AS "rank", value, n AS "count" FROM (
              SELECT {c} AS value, count(*) AS n,
                row_number() OVER (ORDER BY count(*) DESC, {c} ASC NULLS FIRST) AS r
              FROM flights GROUP BY {c}) WHERE r <= 5"""
            for c in PROFILE_CATEGORIES
        )
    ),
)
def category_topk(spark, sf_dir):
    return profile.category_topk(flights(spark, sf_dir), PROFILE_CATEGORIES, k=5)


# --- Filters ---------------------------------------------------------------


@query("filter_not_cancelled", check_sql("SELECT * FROM flights WHERE Cancelled <> 1"))
def filter_not_cancelled(spark, sf_dir):
    return cleaning.not_cancelled(flights(spark, sf_dir))


@query(
    "dropna_subset",
    check_sql(
        """SELECT * FROM flights
        WHERE CRSDepTime IS NOT NULL AND CRSArrTime IS NOT NULL AND ArrDelay IS NOT NULL"""
    ),
)
def dropna_subset(spark, sf_dir):
    return cleaning.drop_incomplete(flights(spark, sf_dir), ["CRSDepTime", "CRSArrTime", LABEL])


@query("clean_flights", check_sql("SELECT * FROM clean", CLEAN))
def clean_flights(spark, sf_dir):
    return cleaning.clean_flights(flights(spark, sf_dir))


@query(
    "hash_split",
    check_sql(
        f"""SELECT Year, Month, DayofMonth, FlightNum, ArrDelay,
          CASE WHEN {TRAIN_CONDITION} THEN 'train' ELSE 'test' END AS part FROM flights"""
    ),
)
def hash_split(spark, sf_dir):
    columns = ["Year", "Month", "DayofMonth", "FlightNum", "ArrDelay"]
    return cleaning.with_part(flights(spark, sf_dir)).select(*columns, "part")


@query("train_test_split", check_sql("SELECT * FROM flights"))
def train_test_split(spark, sf_dir):
    """The two random parts together: every flight, once."""
    train, test = cleaning.random_split(flights(spark, sf_dir))
    return train.unionByName(test)


# --- Projections -----------------------------------------------------------

_UNFILLED = ", ".join(c for c in FLIGHT_COLUMNS if c != "TaxiOut")


@query(
    "project_columns",
    check_sql(f"SELECT {_UNFILLED}, coalesce(TaxiOut, 0) AS TaxiOut FROM flights"),
)
def project_columns(spark, sf_dir):
    return cleaning.pin_columns(flights(spark, sf_dir))


@query("drop_leakage", check_sql(f"SELECT {', '.join(TAKEOFF_COLUMNS)}, TaxiOut FROM flights"))
def drop_leakage(spark, sf_dir):
    return cleaning.takeoff_columns(flights(spark, sf_dir))


_DROPPED = {*LEAKAGE_COLUMNS, *UNINFORMATIVE_COLUMNS}


@query(
    "drop_columns",
    check_sql(f"SELECT {', '.join(c for c in FLIGHT_COLUMNS if c not in _DROPPED)} FROM flights"),
)
def drop_columns(spark, sf_dir):
    return cleaning.drop_unusable(flights(spark, sf_dir))


@query(
    "with_column",
    check_sql(
        """SELECT * REPLACE (TaxiOut + 0 AS TaxiOut), ArrDelay - DepDelay AS DelayGrowth
        FROM flights"""
    ),
)
def with_column(spark, sf_dir):
    # Replaces one column and adds another.
    return flights(spark, sf_dir).withColumns(
        {
            "TaxiOut": F.col("TaxiOut").cast("int"),
            "DelayGrowth": F.col("ArrDelay") - F.col("DepDelay"),
        }
    )


@query(
    "rename_columns",
    check_sql(
        f"""SELECT Year, Month, CRSDepTime, {hhmm_sql('DepDelay + TaxiOut')} AS TakeOffTime,
        {hhmm_sql('CRSElapsedTime')} AS LandingEst FROM flights"""
    ),
)
def rename_columns(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir))
    delayed = clock.shifted(DEPARTURE, clock.minutes_total(["DepDelay", "TaxiOut"]))
    scheduled = clock.shifted(DEPARTURE, clock.minutes_total(["CRSElapsedTime"]))
    return (
        timed.withColumns(
            {
                "FinalDepHHMM": F.expr(clock.hhmm_of(delayed)),
                "FinalArrHHMM": F.expr(clock.hhmm_of(scheduled)),
            }
        )
        .select("Year", "Month", "CRSDepTime", "FinalDepHHMM", "FinalArrHHMM")
        .withColumnRenamed("FinalDepHHMM", "TakeOffTime")
        .withColumnRenamed("FinalArrHHMM", "LandingEst")
    )


_TIMED = f"""
timed AS (
  SELECT {', '.join(TAKEOFF_COLUMNS)}, TaxiOut, {DEPARTURE_SQL} AS CRSDepTimestamp,
    {hhmm_sql('DepDelay + TaxiOut')} AS TakeOffTime,
    {hhmm_sql('DepDelay + TaxiOut + CRSElapsedTime')} AS LandingEst
  FROM flights
)"""

_SPLIT = ", ".join(
    f"CAST(floor({value} / 100) AS INT) AS {name}Hour, CAST({value} % 100 AS INT) AS {name}Minute"
    for name, value in {
        "CRSDepTime": "CRSDepTime",
        "CRSArrTime": "CRSArrTime",
        "TakeOffTime": "TakeOffTime",
        "LandingEst": "LandingEst",
        "DepTime": "coalesce(DepTime, CRSDepTime)",
    }.items()
)
_CLOCK = "CRSDepTime, CRSArrTime, TakeOffTime, LandingEst, DepTime, CRSDepTimestamp"


def _timed(spark, sf_dir) -> DataFrame:
    df = timefeatures.with_departure(cleaning.takeoff_columns(flights(spark, sf_dir)))
    return timefeatures.with_landing_estimate(timefeatures.with_takeoff_time(df))


@query("hhmm_split", check_sql(f"SELECT *, {_SPLIT} FROM timed", _TIMED))
def hhmm_split(spark, sf_dir):
    return timefeatures.split_clock_columns(_timed(spark, sf_dir))


@query("star_except", check_sql(f"SELECT * EXCLUDE ({_CLOCK}) FROM timed", _TIMED))
def star_except(spark, sf_dir):
    return timefeatures.drop_clock_columns(_timed(spark, sf_dir))


@query(
    "lateral_alias",
    check_sql(
        f"""SELECT CRSDepTime, CRSDepTimestamp, TakeOffTime,
          CAST(floor(TakeOffTime / 100) AS INT) AS TakeOffHour FROM timed""",
        _TIMED,
    ),
)
def lateral_alias(spark, sf_dir):
    # Each item uses the alias of the one before it.
    return flights(spark, sf_dir).selectExpr(
        "CRSDepTime",
        f"{clock.departure()} AS {DEPARTURE}",
        f"{timefeatures.takeoff_expression()} AS TakeOffTime",
        f"{clock.hour_of('TakeOffTime')} AS TakeOffHour",
    )


@query(
    "sql_stage",
    check_sql(
        f"SELECT {_UNFILLED}, coalesce(TaxiOut, 0) AS TaxiOut FROM clean",
        CLEAN,
    ),
)
def sql_stage(spark, sf_dir):
    stage = stages.clean_stage(REQUIRED_COLUMNS, zero_fill=("TaxiOut",))
    return stage.transform(flights(spark, sf_dir))


# --- Clock times -----------------------------------------------------------

_PARTS = "Year, Month, DayofMonth, CRSDepTime"


@query("pad_concat", check_sql(f"SELECT {_PARTS}, {DEPARTURE_TEXT} AS departure FROM flights"))
def pad_concat(spark, sf_dir):
    return flights(spark, sf_dir).selectExpr(
        *_PARTS.split(", "), f"{clock.departure_text()} AS departure"
    )


_DEPARTURE_ORACLE = check_sql(f"SELECT {_PARTS}, {DEPARTURE_SQL} AS CRSDepTimestamp FROM flights")


@query("dep_timestamp", _DEPARTURE_ORACLE)
def dep_timestamp(spark, sf_dir):
    return timefeatures.with_departure(flights(spark, sf_dir)).select(*_PARTS.split(", "), DEPARTURE)


@query("dep_timestamp_parsed", _DEPARTURE_ORACLE)
def dep_timestamp_parsed(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir), parsed=True)
    return timed.select(*_PARTS.split(", "), DEPARTURE)


_DELAYED = "DepDelay, TaxiOut, CRSElapsedTime"


def _clock_oracle(minutes: str, name: str) -> str:
    return check_sql(f"SELECT {_PARTS}, {_DELAYED}, {hhmm_sql(minutes)} AS {name} FROM flights")


def _clock_columns(df: DataFrame, name: str) -> DataFrame:
    return df.select(*_PARTS.split(", "), *_DELAYED.split(", "), name)


@query("takeoff_time", _clock_oracle("DepDelay + TaxiOut", "TakeOffTime"))
def takeoff_time(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir))
    return _clock_columns(timefeatures.with_takeoff_time(timed), "TakeOffTime")


@query(
    "takeoff_time_nullsafe",
    _clock_oracle("coalesce(DepDelay, 0) + coalesce(TaxiOut, 0)", "TakeOffTime"),
)
def takeoff_time_nullsafe(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir))
    return _clock_columns(timefeatures.with_takeoff_time(timed, null_as_zero=True), "TakeOffTime")


@query("landing_est", _clock_oracle("DepDelay + TaxiOut + CRSElapsedTime", "LandingEst"))
def landing_est(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir))
    return _clock_columns(timefeatures.with_landing_estimate(timed), "LandingEst")


@query("landing_est_scheduled", _clock_oracle("coalesce(CRSElapsedTime, 0)", "LandingEst"))
def landing_est_scheduled(spark, sf_dir):
    timed = timefeatures.with_departure(flights(spark, sf_dir))
    return _clock_columns(
        timefeatures.with_landing_estimate(timed, after_takeoff=False), "LandingEst"
    )


@query(
    "clock_text",
    check_sql(
        f"""SELECT CRSDepTime, DepDelay,
          strftime({DEPARTURE_SQL} + to_minutes(DepDelay), '%H%M') AS clock,
          CAST(strftime({DEPARTURE_SQL} + to_minutes(DepDelay), '%H%M') AS INT) AS hhmm
        FROM flights"""
    ),
)
def clock_text(spark, sf_dir):
    shifted = clock.shifted(DEPARTURE, "DepDelay")
    return (
        timefeatures.with_departure(flights(spark, sf_dir))
        .select("CRSDepTime", "DepDelay", F.expr(clock.clock_text(shifted)).alias("clock"))
        .withColumn("hhmm", F.col("clock").cast("int"))
    )


@query(
    "coalesce_fill",
    check_sql(
        """SELECT DepTime, CRSDepTime, TaxiOut, coalesce(TaxiOut, 0) AS TaxiOutFilled,
          coalesce(DepTime, CRSDepTime) AS DepTimeFilled FROM flights"""
    ),
)
def coalesce_fill(spark, sf_dir):
    return flights(spark, sf_dir).select(
        "DepTime",
        "CRSDepTime",
        "TaxiOut",
        F.coalesce("TaxiOut", F.lit(0)).alias("TaxiOutFilled"),
        F.coalesce("DepTime", "CRSDepTime").alias("DepTimeFilled"),
    )


# --- Medians ---------------------------------------------------------------


@query(
    "taxi_out_median",
    check_sql(
        "SELECT quantile_disc(TaxiOut, 0.5) AS median FROM flights WHERE TaxiOut IS NOT NULL"
    ),
)
def taxi_out_median(spark, sf_dir):
    return median.median(flights(spark, sf_dir), "TaxiOut")


@query(
    "taxi_out_median_fill",
    check_sql(
        """SELECT * REPLACE (coalesce(
            (SELECT quantile_disc(coalesce(TaxiOut, 0), 0.5) FROM flights), 0) AS TaxiOut)
        FROM flights"""
    ),
)
def taxi_out_median_fill(spark, sf_dir):
    return median.fill_with_batch_median(flights(spark, sf_dir), "TaxiOut")


@query(
    "taxi_out_sketch",
    check_sql(
        """SELECT s AS share, TRUE AS within_error
        FROM (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) AS t(s)"""
    ),
)
def taxi_out_sketch(spark, sf_dir):
    """Quantiles from a sketch merged in two levels, held against the exact ranks."""
    values = flights(spark, sf_dir).select("TaxiOut").dropna()
    found = sketch.quantiles(sketch.sketch_column(values, "TaxiOut"), [0.1, 0.5, 0.9])
    counted = values.groupBy("TaxiOut").count()
    ranks = counted.join(F.broadcast(found)).groupBy("share", "value").agg(  # three rows
        (F.sum(F.when(F.col("TaxiOut") < F.col("value"), F.col("count")).otherwise(0)) / F.sum("count")).alias("below"),
        (F.sum(F.when(F.col("TaxiOut") <= F.col("value"), F.col("count")).otherwise(0)) / F.sum("count")).alias("upto"),
    )
    error = 2 * sketch.rank_error()
    return ranks.select(
        "share", ((F.col("below") - error <= F.col("share")) & (F.col("share") <= F.col("upto") + error)).alias("within_error")
    )


# --- Metrics and choice ----------------------------------------------------


def _predicted(spark, sf_dir) -> DataFrame:
    df = cleaning.clean_flights(flights(spark, sf_dir))
    return df.select(LABEL, F.expr(ARITHMETIC_PREDICTION).alias("prediction"))


_ERRORS = f"""
errors AS (
  SELECT ArrDelay AS y, ArrDelay - {ARITHMETIC_PREDICTION} AS e FROM clean
)"""
_RMSE = "sqrt(avg(e * e))"
_MAE = "avg(abs(e))"
_R2 = "1 - avg(e * e) / var_pop(y)"


@query("metric_rmse", check_sql(f"SELECT round({_RMSE}, 6) AS rmse FROM errors", CLEAN, _ERRORS))
def metric_rmse(spark, sf_dir):
    return rounded(_predicted(spark, sf_dir).agg(metrics.rmse().alias("rmse")))


@query("metric_mae", check_sql(f"SELECT round({_MAE}, 6) AS mae FROM errors", CLEAN, _ERRORS))
def metric_mae(spark, sf_dir):
    return rounded(_predicted(spark, sf_dir).agg(metrics.mae().alias("mae")))


@query("metric_r2", check_sql(f"SELECT round({_R2}, 6) AS r2 FROM errors", CLEAN, _ERRORS))
def metric_r2(spark, sf_dir):
    return rounded(_predicted(spark, sf_dir).agg(metrics.r2().alias("r2")))


@query(
    "evaluation_report",
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS metric, round({text}, 6) AS value FROM errors"
            for name, text in {"RMSE": _RMSE, "MAE": _MAE, "R2": _R2}.items()
        ),
        CLEAN,
        _ERRORS,
    ),
)
def evaluation_report(spark, sf_dir):
    return rounded(metrics.evaluation_report(_predicted(spark, sf_dir)))


# Three arithmetic predictors; the last is right but for rare large misses, so
# that the score rule takes both its branches.
_PREDICTORS = {
    "taxi aware": ARITHMETIC_PREDICTION,
    "delay only": "CAST(DepDelay + 5 AS DOUBLE)",
    "rare misses": "CAST(ArrDelay + CASE WHEN FlightNum % 20 = 0 THEN 100 ELSE 0 END AS DOUBLE)",
}
_MEASURED = "measured AS (" + " UNION ALL ".join(
    f"""SELECT CAST({i} AS INT) AS order_no, '{name}' AS name,
      sqrt(avg((ArrDelay - {p}) * (ArrDelay - {p}))) AS rmse, avg(abs(ArrDelay - {p})) AS mae,
      1 - avg((ArrDelay - {p}) * (ArrDelay - {p})) / var_pop(ArrDelay) AS r2
    FROM clean"""
    for i, (name, p) in enumerate(_PREDICTORS.items())
) + ")"
_SCORED = """
scored AS (
  SELECT order_no, name, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2,
    round(CASE WHEN rmse > 2 * mae THEN mae ELSE rmse END, 6) AS score,
    CASE WHEN rmse > 2 * mae THEN 'MAE' ELSE 'RMSE' END AS metric
  FROM measured
)"""


def _leaderboard(spark, sf_dir) -> DataFrame:
    df = cleaning.clean_flights(flights(spark, sf_dir))
    columns = {name: f"prediction_{i}" for i, name in enumerate(_PREDICTORS)}
    predicted = df.withColumns({columns[n]: F.expr(p) for n, p in _PREDICTORS.items()})
    return leaderboard.with_score(metrics.compare_predictions(predicted, columns))


@query("score_rule", check_sql("SELECT * FROM scored", CLEAN, _MEASURED, _SCORED))
def score_rule(spark, sf_dir):
    return rounded(_leaderboard(spark, sf_dir))


@query(
    "select_best_model",
    check_sql(
        "SELECT * FROM scored ORDER BY score, order_no LIMIT 1", CLEAN, _MEASURED, _SCORED
    ),
)
def select_best_model(spark, sf_dir):
    return rounded(leaderboard.best_model(_leaderboard(spark, sf_dir)))
