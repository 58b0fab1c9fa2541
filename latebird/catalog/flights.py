"""The flight relation that the queries run on, derived from `lineitem`.

The same SQL text serves Spark and the check database; only the ISO weekday is
spelled differently. The data is invented: it has the shapes the operators
need (nulls, 24:00 departures, cancelled flights), and says nothing about
real flights.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

from latebird.functions.bucket import bucket, share_of_buckets
from latebird.session import drop_at_exit, stage_table

_PARTS = """
k AS (
  SELECT *, l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber*101 AS h FROM {lineitem}
), m AS (
  SELECT *, h % 1441 AS dep_m, 100 + (l_partkey % 40)*50 AS dist,
    CASE WHEN h % 50 = 0 THEN 1 ELSE 0 END AS canc,
    CASE WHEN h % 53 = 0 THEN NULL ELSE h % 61 - 10 END AS dd,
    CASE WHEN h % 11 = 0 THEN NULL ELSE 5 + h % 26 END AS tx
  FROM k
), flights AS (
SELECT
  CAST(extract(YEAR FROM l_shipdate) AS INT) AS Year,
  CAST(extract(MONTH FROM l_shipdate) AS INT) AS Month,
  CAST(extract(DAY FROM l_shipdate) AS INT) AS DayofMonth,
  CAST({dow} AS INT) AS DayOfWeek,
  CAST(CASE WHEN canc = 1 OR h % 37 = 0 THEN NULL ELSE FLOOR(dep_m/60)*100 + dep_m % 60 END AS INT) AS DepTime,
  CAST(FLOOR(dep_m/60)*100 + dep_m % 60 AS INT) AS CRSDepTime,
  CAST(CASE WHEN canc = 1 THEN NULL ELSE FLOOR(((dep_m+95) % 1440)/60)*100 + ((dep_m+95) % 1440) % 60 END AS INT) AS ArrTime,
  CAST(CASE WHEN h % 97 = 0 THEN NULL ELSE FLOOR(((dep_m+90) % 1440)/60)*100 + ((dep_m+90) % 1440) % 60 END AS INT) AS CRSArrTime,
  concat(l_returnflag, l_linestatus) AS UniqueCarrier,
  CAST(h % 3000 AS INT) AS FlightNum,
  CASE WHEN h % 41 = 0 THEN NULL ELSE concat('N', CAST(l_partkey % 200 AS VARCHAR(10))) END AS TailNum,
  CAST(CASE WHEN canc = 1 THEN NULL ELSE 35 + FLOOR(dist/8) END AS INT) AS ActualElapsedTime,
  CAST(CASE WHEN h % 89 = 0 THEN NULL ELSE 30 + FLOOR(dist/8) END AS INT) AS CRSElapsedTime,
  CAST(CASE WHEN canc = 1 THEN NULL ELSE 10 + FLOOR(dist/8) END AS INT) AS AirTime,
  CAST(CASE WHEN canc = 1 OR h % 71 = 0 THEN NULL ELSE COALESCE(dd,0) + COALESCE(tx,0) - 15 + l_partkey % 9 END AS INT) AS ArrDelay,
  CAST(dd AS INT) AS DepDelay,
  concat('S', CAST(l_suppkey % 30 AS VARCHAR(10))) AS Origin,
  concat('P', CAST(l_partkey % 25 AS VARCHAR(10))) AS Dest,
  CAST(dist AS INT) AS Distance,
  CAST(CASE WHEN canc = 1 THEN NULL ELSE 3 + h % 9 END AS INT) AS TaxiIn,
  CAST(tx AS INT) AS TaxiOut,
  CAST(CASE WHEN h % 401 = 0 THEN NULL ELSE canc END AS INT) AS Cancelled,
  CASE WHEN canc = 1 THEN substr('ABCD', CAST(1 + h % 4 AS INT), 1) END AS CancellationCode,
  CAST(CASE WHEN h % 499 = 0 THEN 1 ELSE 0 END AS INT) AS Diverted,
  CAST(CASE WHEN h % 5 = 0 THEN h % 20 END AS INT) AS CarrierDelay,
  CAST(CASE WHEN h % 7 = 0 THEN h % 15 END AS INT) AS WeatherDelay,
  CAST(CASE WHEN h % 9 = 0 THEN h % 25 END AS INT) AS NASDelay,
  CAST(CASE WHEN h % 13 = 0 THEN h % 5 END AS INT) AS SecurityDelay,
  CAST(CASE WHEN h % 17 = 0 THEN h % 30 END AS INT) AS LateAircraftDelay
FROM m
)"""


_staged: dict[tuple[str, str], DataFrame] = {}

#: Whole flights that one task reads: some 170 MB as rows.
ROWS_A_TASK = 500_000


def derive_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _PARTS.replace("{dow}", "extract(DAYOFWEEK_ISO FROM l_shipdate)")
    return spark.sql(
        f"WITH {parts} SELECT * FROM flights",
        lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight table, written once per session and data directory.

    Real flights are a stored table. Reading one keeps the queries' plans about
    the queries: filters and column lists reach the scan, where over the long
    expressions above they would be multiplied into methods that the JVM
    refuses to compile. It is written as `lineitem` is read, without a shuffle, in
    files of as many rows as a task can sort in memory, and at least one a core.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        derived = derive_flights(spark, sf_dir)
        total = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # read from the footers
        share = ceil(total / spark.sparkContext.defaultParallelism)
        _staged[key], path = stage_table(derived, "flights", rows=min(max(share, 1), ROWS_A_TASK))
        drop_at_exit(spark, path)
    return _staged[key]


def check_sql(body: str, *ctes: str) -> str:
    """Check SQL: `body` may read `flights` and the given further CTEs."""
    parts = _PARTS.replace("{dow}", "extract(isodow FROM l_shipdate)").replace(
        "{lineitem}", "lineitem"
    )
    return "WITH " + ",".join([parts, *ctes]) + "\n" + body.strip()


# CTEs and fragments for check SQL.

CLEAN = """
clean AS (
  SELECT * FROM flights
  WHERE CRSDepTime IS NOT NULL AND CRSArrTime IS NOT NULL AND ArrDelay IS NOT NULL
    AND Year IS NOT NULL AND Month IS NOT NULL AND DayofMonth IS NOT NULL
    AND DayOfWeek IS NOT NULL AND UniqueCarrier IS NOT NULL AND CRSElapsedTime IS NOT NULL
    AND DepDelay IS NOT NULL AND Origin IS NOT NULL AND Dest IS NOT NULL
    AND Distance IS NOT NULL AND Cancelled <> 1
)"""

_DAY = "concat(CAST(Year AS VARCHAR), lpad(CAST(Month AS VARCHAR), 2, '0'), lpad(CAST(DayofMonth AS VARCHAR), 2, '0'))"
DEPARTURE_TEXT = f"concat({_DAY}, lpad(CAST(CRSDepTime AS VARCHAR), 4, '0'))"
DEPARTURE_SQL = f"""CASE WHEN CRSDepTime = 2400
    THEN strptime(concat({_DAY}, '0000'), '%Y%m%d%H%M') + INTERVAL 1 DAY
    ELSE strptime({DEPARTURE_TEXT}, '%Y%m%d%H%M') END"""


def hhmm_sql(minutes: str, departure: str = DEPARTURE_SQL) -> str:
    return (
        f"CAST(strftime({departure} + to_minutes(CAST({minutes} AS INT)), '%H%M') AS INT)"
    )


# The prediction that the metric queries measure: simple arithmetic, so that
# the check database can repeat it.
ARITHMETIC_PREDICTION = "CAST(DepDelay + coalesce(TaxiOut, 0) - 11 AS DOUBLE)"

TRAIN_CONDITION = f"{bucket(89)} < {share_of_buckets(0.8)}"
