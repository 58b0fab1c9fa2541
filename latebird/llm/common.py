"""What the operators of this subpackage share: tables, staging, shipping code to workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebird.session import drop_at_exit, scratch_path, ship_package, stage_table  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder; the folder goes when the program ends."""
    again, path = stage_table(df, name)
    drop_at_exit(df.sparkSession, path)
    return again


def scratch(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    drop_at_exit(spark, path)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme of the file system that Spark would look for it in, so
    that a worker which opens it by itself looks in the same place."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop_path).toString()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unused_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or with underscores added until the input has no such column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
