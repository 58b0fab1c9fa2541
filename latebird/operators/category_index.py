"""Category indices kept as a table, for columns of any number of values.

`FrequencyIndexer` brings a column's labels to the driver and into the schema;
here they never leave the executors. Values are counted by the shuffle, ranked
by range partitions, and the dictionary is a table (column_name, value, n, index)
that is joined to the rows. Since indices follow frequency, the first
`HEAD` values are the frequent ones: they are broadcast, which bounds the
broadcast, and only the others, none of which is in more than one of `HEAD` rows,
go through a shuffle join. So a value that a third of all rows have is no hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latebird.operators.encoding import index_name
from latebird.session import drop_at_exit, stage_table
from latebird.sources import write_table

#: Values of a column that are broadcast.
HEAD = 10_000
#: Parts among which rows without a rare value are dealt in the join with those.
_SALTS = 4_096


@dataclass(frozen=True)
class CategoryIndex:
    """A dictionary of values and how many each column has."""

    table: DataFrame
    sizes: Mapping[str, int]

    def transform(self, df: DataFrame, head: int = HEAD) -> DataFrame:
        """Add `<column>_idx` (double) for each column: the value's index, or the
        number of values for null and unseen ones, as the model form does."""
        for column, size in self.sizes.items():
            df = self._indexed(df, column, size, head)
        return df

    def _indexed(self, df: DataFrame, column: str, size: int, head: int) -> DataFrame:
        own = self.table.where(F.col("column_name") == column)
        frequent = own.where(F.col("index") < head).select(
            F.col("value").alias("_frequent"), F.col("index").alias("_index")
        )
        text = F.col(column).cast("string")
        # At most `head` rows are broadcast.
        found = df.join(F.broadcast(frequent), text == F.col("_frequent"), "left").drop("_frequent")
        index = F.col("_index")
        if size > head:
            rare = own.where(F.col("index") >= head).select(
                F.lit(True).alias("_is_rare"), F.col("value").alias("_rare"), F.col("index").alias("_rare_index")
            )
            wanted = F.col("_index").isNull() & text.isNotNull()
            # Rows that look for nothing are dealt evenly by what they hold.
            salt = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if kind != "void" and not kind.startswith("map")]), _SALTS)
            keyed = found.withColumns({"_wanted": wanted, "_key": F.when(wanted, text).otherwise(salt.cast("string"))})
            joined = keyed.join(
                rare, (F.col("_wanted") == F.col("_is_rare")) & (F.col("_key") == F.col("_rare")), "left"
            )
            found, index = joined, F.coalesce("_index", "_rare_index")
        indexed = found.withColumn(index_name(column), F.coalesce(index, F.lit(size)).cast("double"))
        return indexed.drop("_index", "_is_rare", "_rare", "_rare_index", "_wanted", "_key")

    def save(self, path: str) -> None:
        write_table(self.table, path, partition_by=["column_name"])


def load_category_index(spark: SparkSession, path: str) -> CategoryIndex:
    table = spark.read.schema("value string, n long, index long, column_name string").parquet(path)
    return CategoryIndex(table, _sizes(table))


def _sizes(table: DataFrame) -> dict[str, int]:
    counted = table.groupBy("column_name").count().collect()  # one row a column
    return {r["column_name"]: r["count"] for r in sorted(counted, key=lambda r: r["column_name"])}


def fit_category_index(df: DataFrame, columns: Sequence[str]) -> CategoryIndex:
    """Count and rank the values of `columns` in `df`: by falling frequency, ties
    in value order; numbers as text; nulls are left out. A column without values
    has size 0. The table stays in the shared folder until the program ends."""
    spark = df.sparkSession
    names = F.array(*[F.lit(c) for c in columns])
    values = F.array(*[F.col(c).cast("string") for c in columns])
    counted = (
        df.select(F.posexplode(values).alias("place", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("place", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Dealt by range, a part holds a stretch of the ranking; written, its number stays.
    dealt = counted.repartitionByRange("place", F.desc("n"), "value").withColumn("part", F.spark_partition_id())
    stored, path = stage_table(dealt, "category-counts")
    drop_at_exit(spark, path)
    within = Window.partitionBy("part", "place").orderBy(F.desc("n"), "value")
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part and column that it holds.
    offsets = stored.groupBy("place", "part").count().select(
        "place", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    ranked = stored.withColumn("rank", F.row_number().over(within)).join(F.broadcast(offsets), ["place", "part"])
    table = ranked.select(
        F.get(names, F.col("place")).alias("column_name"), "value", "n", (F.col("offset") + F.col("rank") - 1).alias("index")
    )
    table, path = stage_table(table, "category-index")
    drop_at_exit(spark, path)
    return CategoryIndex(table, dict.fromkeys(columns, 0) | _sizes(table))
