"""Flight readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebird.schema import FLIGHT_COLUMNS

NULL_TOKEN = "NA"


def read_flights_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    infer: bool = False,
    null_token: str = NULL_TOKEN,
    fail_fast: bool = False,
    types: Mapping[str, T.DataType] = FLIGHT_COLUMNS,
    malformed: str | None = None,
) -> DataFrame:
    """Read headed flight CSVs: one file, several files, a glob or a directory.

    Column names come from the header, types from the declared columns (or
    `types`); an undeclared column is text. Only a header line is read for that, where
    `infer=True`, which takes the types from the data, reads the whole input an
    extra time and may give batches different types. `enforceSchema=False`
    makes Spark compare every file's header, so a file whose columns are in
    another order than the first one's fails instead of filling wrong columns.

    A cell that is no value of its type becomes null, unless `fail_fast` makes it
    fail the job; `count_malformed` says how many lines hold such cells, and
    `malformed` names a further column that holds them whole, as far as the
    columns that are read show it.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("nullValue", null_token)
    if fail_fast:
        reader = reader.option("mode", "FAILFAST")
    if infer:
        return reader.option("inferSchema", True).csv(paths)
    header = reader.csv(paths).columns
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
        fields.append(T.StructField(malformed, T.StringType()))
    return reader.option("enforceSchema", False).schema(T.StructType(fields)).csv(paths)


def count_malformed(
    spark: SparkSession, path: str | Sequence[str], *, null_token: str = NULL_TOKEN
) -> int:
    """Lines of flight CSVs with a cell that is no value of its declared type, or
    with too few or too many cells."""
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("nullValue", null_token)
    fields = [T.StructField(n, FLIGHT_COLUMNS.get(n, T.StringType())) for n in reader.csv(paths).columns]
    schema = T.StructType([*fields, T.StructField("_malformed", T.StringType())])
    lines = reader.option("columnNameOfCorruptRecord", "_malformed").schema(schema).csv(paths)
    # The parser looks only at cells that are asked for, so all of them are.
    seen = lines.select("_malformed", F.xxhash64(*[f.name for f in fields]).alias("cells"))
    return seen.agg(F.count("_malformed").alias("n"), F.bit_xor("cells")).first()["n"]


def read_flights_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read flights kept as Parquet; filters and column lists reach the scan."""
    return spark.read.parquet(path)


def write_flights_csv(df: DataFrame, path: str, null_token: str = NULL_TOKEN) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", null_token)
        .csv(path)
    )


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace_partitions: bool = False,
) -> None:
    """Write Parquet, vectors included. Partition by `Year` where batches are
    read by year, so that later reads skip the other years' files.
    `replace_partitions`: overwrite only the partitions that `df` has rows of."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        if mode != "overwrite" or not partition_by:
            raise ValueError("replacing partitions needs partition columns and mode overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
