"""Quantiles of large batches from mergeable sketches.

`approx_median` ends in one task that merges a sketch from every input partition.
Here sketches (KLL, of bounded size) are merged in two levels: the partitions'
sketches go to `PARTS` tasks by partition number, and one task merges `PARTS` of
them. A stored sketch can be merged with those of other batches, and two batches
be compared, without reading the rows again.

The rank of a found quantile is off by at most `rank_error(k)` of all rows, with
99 % confidence; up to `k` values it is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch, and the sketches that the last task merges.
K = 4_096
PARTS = 32

SKETCH = "sketch"


def rank_error(k: int = K) -> float:
    """The rank error of a KLL sketch in normalised rank, at 99 % confidence: a
    little under 2.446 / k^0.9433, as its authors fitted it."""
    return 2.446 / k**0.9433


def sketch_column(df: DataFrame, column: str, k: int = K, parts: int = PARTS) -> DataFrame:
    """One row (sketch) for the non-null values of an integer column; null if there
    are none."""
    values = df.select(F.col(column).cast("bigint").alias("v"), F.pmod(F.spark_partition_id(), parts).alias("part"))
    # Each task's rows are sketched before the shuffle, which takes one row a task and part.
    level = values.where(F.col("v").isNotNull()).groupBy("part").agg(F.kll_sketch_agg_bigint("v", k).alias(SKETCH))
    return merge_sketches(level, k)


def merge_sketches(sketches: DataFrame, k: int = K) -> DataFrame:
    """One row with the sketch of all rows (sketch) of a small table, such as the
    stored sketches of earlier batches."""
    return sketches.agg(F.kll_merge_agg_bigint(SKETCH, k).alias(SKETCH))


def quantiles(sketch: DataFrame, shares: Sequence[float] = (0.5,)) -> DataFrame:
    """Rows (share, value) from a one-row sketch: about that share of the values do
    not exceed `value`, which is null where there are none."""

    def row(share: float) -> Column:
        value = F.when(_filled(SKETCH), F.kll_sketch_get_quantile_bigint(SKETCH, F.lit(share)))
        return F.struct(F.lit(share).alias("share"), value.alias("value"))

    return sketch.select(F.inline(F.array(*[row(float(s)) for s in shares])))


def _filled(sketch: str) -> Column:
    """Whether a sketch has seen a value; an empty one has no quantiles."""
    return F.coalesce(F.kll_sketch_get_n_bigint(sketch) > 0, F.lit(False))


def largest_shift(before: DataFrame, after: DataFrame, steps: int = 20) -> DataFrame:
    """One row (shift): the largest difference between two batches' shares of values
    up to a point, over `steps` - 1 quantiles of the first. From 0 for batches
    that are alike to 1; `rank_error` of both comes on top. Null if one is empty."""
    # The points are constants to the rank function: `steps` - 1 numbers come to the driver.
    found = quantiles(before, [i / steps for i in range(1, steps)]).collect()
    points = sorted({r["value"] for r in found if r["value"] is not None})

    def ranks(sketch: DataFrame, name: str) -> DataFrame:
        each = F.array(*[F.kll_sketch_get_rank_bigint(SKETCH, F.lit(p).cast("bigint")) for p in points])
        return sketch.select(F.when(_filled(SKETCH), each).alias(name))

    both = ranks(before, "first").join(F.broadcast(ranks(after, "second")))  # one row each
    apart = F.zip_with("first", "second", lambda a, b: F.abs(a - b))
    return both.select(F.array_max(apart).cast("double").alias("shift"))


def fill_with_sketch_median(df: DataFrame, column: str, sketch: DataFrame) -> DataFrame:
    """Fill the nulls of an integer column with a sketch's median, 0 without one.
    The sketch is stored, of the batch or of the training rows."""
    median = quantiles(sketch).select("value").scalar()
    return df.withColumn(column, F.coalesce(column, median, F.lit(0)).cast(df.schema[column].dataType))
