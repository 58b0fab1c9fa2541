"""Looking at a flight table: summaries, null counts, category frequencies.

Each function is one pass over the input. Partial aggregation runs before every
shuffle, so a value that holds a third of the rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def _columns_of(df: DataFrame, kind: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, typed.

    Each row is unfolded into (position, value) pairs and aggregated by
    position: five aggregates instead of five per column, which would be too
    many for generated code. Every task sends on one row per column. The row of
    nulls gives an empty table its zero counts.
    """
    names = list(columns or _columns_of(df, T.NumericType))
    values = df.select(F.array(*[F.col(c).cast("double") for c in names]).alias("values"))
    nothing = df.sparkSession.range(1).select(
        F.array_repeat(F.lit(None).cast("double"), len(names)).alias("values")
    )
    summary = (
        values.unionAll(nothing)
        .select(F.posexplode("values").alias("position", "value"))
        .groupBy("position")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev("value").alias("stddev"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    name = F.array(*[F.lit(c) for c in names])[F.col("position")]
    return summary.select(name.alias("column"), "count", "mean", "stddev", "min", "max")


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, first and last value in sort order of the text columns."""
    names = columns or _columns_of(df, T.StringType)
    # One aggregation; its only row is then unfolded into a row per column.
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        ).alias(c)
        for c in names
    ]
    return df.agg(*rows).select(F.inline(F.array(*[F.col(f"`{c}`") for c in names])))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of one column, null being a value."""
    return df.groupBy(column).count()


def category_topk(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The `k` most frequent values of each column, ties in value order.

    The input is read once for all columns. Ranking works on counted values
    only, and Spark cuts each task's values to the `k` best before the shuffle
    (`WindowGroupLimit`), so no task receives a whole column.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = text.unpivot([], list(columns), "column", "value").groupBy("column", "value").count()
    best_first = Window.partitionBy("column").orderBy(
        F.desc("count"), F.asc_nulls_first("value")
    )
    return (
        counted.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("column", "rank", "value", "count")
    )
