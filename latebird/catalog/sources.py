"""Queries: CSV reading. The flights are written as headed CSV with `NA` for
null, in the shared folder, once per session and data directory, one file a core."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.catalog import query
from latebird.catalog.flights import check_sql, flights
from latebird.operators import profile
from latebird.schema import FLIGHT_COLUMNS
from latebird.session import drop_at_exit, scratch_path
from latebird.sources import narrowest_types, read_flights_csv, write_flights_csv, write_table

_ALL = check_sql("SELECT * FROM flights")
_written: dict[tuple[str, str], str] = {}


def _csv_dir(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = scratch_path(spark, "flights-csv")
        write_flights_csv(flights(spark, sf_dir).coalesce(spark.sparkContext.defaultParallelism), path)
        drop_at_exit(spark, path)
        _written[key] = path
    return _written[key]


@query("csv_scan", _ALL)
def csv_scan(spark, sf_dir):
    """One file at a time, each by its own read."""
    files = spark.read.text(_csv_dir(spark, sf_dir)).inputFiles()
    return reduce(DataFrame.unionByName, [read_flights_csv(spark, file) for file in files])


@query("csv_scan_dir", _ALL)
def csv_scan_dir(spark, sf_dir):
    return read_flights_csv(spark, _csv_dir(spark, sf_dir))


@query("csv_infer_types", _ALL)
def csv_infer_types(spark, sf_dir):
    return read_flights_csv(spark, _csv_dir(spark, sf_dir), infer=True)


@query(
    "csv_null_token",
    check_sql(
        "SELECT "
        + ", ".join(f"count(*) - count({c}) AS {c}" for c in FLIGHT_COLUMNS)
        + " FROM flights"
    ),
)
def csv_null_token(spark, sf_dir):
    return profile.null_counts(read_flights_csv(spark, _csv_dir(spark, sf_dir)))


def _type_row(column: str) -> str:
    kind = FLIGHT_COLUMNS[column].simpleString()
    return (
        f"SELECT '{column}' AS column_name, CASE WHEN count({column}) = 0 THEN 'void' ELSE '{kind}' END AS type_name,"
        f" count({column}) AS cells FROM flights"
    )


@query("csv_narrowest_types", check_sql(" UNION ALL ".join(map(_type_row, FLIGHT_COLUMNS))))
def csv_narrowest_types(spark, sf_dir):
    return narrowest_types(spark, _csv_dir(spark, sf_dir))


@query(
    "partition_overwrite",
    check_sql(
        """SELECT Year, count(*) AS flights,
          sum(Distance + CASE WHEN Year = (SELECT min(Year) FROM flights) THEN 1 ELSE 0 END)::BIGINT AS distance
        FROM flights WHERE Year IS NOT NULL GROUP BY Year"""
    ),
)
def partition_overwrite(spark, sf_dir):
    """A table parted by year, of which one year is then written again."""
    path = scratch_path(spark, "by-year")
    drop_at_exit(spark, path)
    rows = flights(spark, sf_dir).where("Year IS NOT NULL").select("Year", "Distance", "ArrDelay")
    write_table(rows, path, partition_by=["Year"])
    first = rows.agg(F.min("Year")).first()[0]
    again = rows.where(F.col("Year") == first).withColumn("Distance", F.col("Distance") + 1)
    write_table(again, path, partition_by=["Year"], replace_partitions=True)
    written = spark.read.schema(rows.schema).parquet(path)
    return written.groupBy("Year").agg(F.count(F.lit(1)).alias("flights"), F.sum("Distance").alias("distance"))
