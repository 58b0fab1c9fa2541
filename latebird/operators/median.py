"""The median of an integer column, exactly, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGIT_BITS = 16
_WIDTHS = {T.ByteType: 32, T.ShortType: 32, T.IntegerType: 32, T.LongType: 64}


def approx_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column: Spark's `percentile_approx` at one half, for any
    numeric type. It is exact up to 10,000 different values, and ends in one
    task that merges a bounded sketch from every input partition."""
    return df.agg(F.percentile_approx(column, F.lit(0.5)).alias("median"))


def integer_bits(df: DataFrame, column: str) -> int:
    """How many bits the exact median ranks; types that aren't integers raise."""
    kind = type(df.schema[column].dataType)
    if kind not in _WIDTHS:
        raise TypeError(f"no exact median of {column} ({kind.__name__}): use approx_median")
    return _WIDTHS[kind]


def median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column: the smallest value that half of the non-null rows
    do not exceed; null if there are none. Exact, for integers of any width;
    other types raise, and the caller may choose `approx_median`.

    Counting per value first spreads the work over the shuffle. The counts are
    then ranked by 16 bits of the value at a time, from the top, so a ranking
    task sees at most 65,536 rows however many different values there are. All
    steps reuse one shuffle.
    """
    width = integer_bits(df, column)
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("bigint").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = medians_of_counts(counted.withColumn("of", F.lit(0)), width)
    return found.agg(F.min("median").cast(df.schema[column].dataType).alias("median"))


def medians_of_counts(counted: DataFrame, width: int = 64) -> DataFrame:
    """(of, median) for rows (of, v, n): how often each value `v`, a bigint of
    `width` bits, occurs in each of a few sets `of`. A set without rows has none."""
    # One row for each set: the leading bits of its median, and how many rows in to look for it.
    home = counted.groupBy("of").agg(F.ceil(F.sum("n") / 2).alias("target")).withColumn(
        "lead", F.lit(None).cast("bigint")
    )
    for shift in range(width - _DIGIT_BITS, -1, -_DIGIT_BITS):
        above = shift + _DIGIT_BITS
        inside = counted.join(F.broadcast(home), "of")
        if above < width:
            inside = inside.where(F.shiftright("v", above) == F.col("lead"))
        blocks = inside.groupBy("of", F.shiftright("v", shift).alias("block"), "target").agg(F.sum("n").alias("n"))
        running = Window.partitionBy("of").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.sum("n").over(running)
        home = (
            blocks.select("of", "block", "target", (upto - F.col("n")).alias("before"), upto.alias("upto"))
            .where((F.col("before") < F.col("target")) & (F.col("upto") >= F.col("target")))
            .select("of", F.col("block").alias("lead"), (F.col("target") - F.col("before")).alias("target"))
        )
    return home.select("of", F.col("lead").alias("median"))


def fill_with_batch_median(df: DataFrame, column: str, null_as_zero: bool = True) -> DataFrame:
    """Set `column` to its own median on every row, null or not; 0 if there is
    no median. Kept because the original steps work this way: the value
    replaces the column. To fill nulls only, use `impute` or `MedianFill`.

    The median is `approx_median`, as in the pipeline stage of the same name.
    `null_as_zero` takes it over zero-filled values.
    """
    source = df.select(F.coalesce(column, F.lit(0)).alias(column)) if null_as_zero else df
    return df.withColumn(column, F.coalesce(approx_median(source, column).scalar(), F.lit(0)))
