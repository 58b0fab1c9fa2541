"""Shards by a k-d tree: weighted median splits along the widest metadata dimension.

The points of the tree are groups of equal texts, with their bytes as weight, so
that copies share a shard. A group too large for that is dealt out by the hash
of doc_id into parts, which are points of their own; the list of such groups is
bounded by the number of shards. A point's dimensions are the length of its
text, its source, its language and its smallest doc_id.

A node that is to hold k shards is split along the dimension in which its points
spread widest (as a share of the whole spread) at the weighted quantile that
gives each side its share of the k shards. The quantile is exact: each dimension
has a 63-bit key (31 bits of value, 32 of the group's hash), and a few passes
of counting by 10 bits of the key, for all nodes of a level at once, find the
point at which the bytes cross. What comes to the driver is these counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latebird.llm.common import staged, text_or_empty

DIMENSIONS = ("length", "source", "lang", "doc_id")
#: A group of more than this share of a shard, in bytes or rows, is dealt out.
GROUP_SHARE = 0.1
#: A group that is dealt out has this many times finer parts, so that a split of the
#: tree, which takes whole parts, misses its quantile by little.
FINER = 4
DIGIT_BITS = 10
KEY_BITS = 63
#: Bytes that a row adds to its text.
ROW_BYTES = 8
#: Rows of a shard numbered by one task.
NUMBERED = 50_000
#: Splits beyond which they aren't broadcast.
BROADCAST_SPLITS = 100_000


@dataclass
class Node:
    number: int
    low: int  # first shard
    high: int  # shard after the last
    dimension: int = 0
    split: int = 0  # keys below go left


def _sized(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        F.length(text).alias("length"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        # Written with the sizes, so it stays; null and repeated ids are dealt out by it.
        F.monotonically_increasing_id().alias("row"),
    )


def _points(rows: DataFrame, shards: int, group_share: float) -> tuple[DataFrame, DataFrame]:
    """(rows with the part of their group, points of the tree)."""
    group = ["hash", "text_crc32", "size"]
    groups = rows.groupBy(*group).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    most_rows = max(1.0, group_share * total["n"] / shards)
    most_bytes = max(1.0, group_share * (total["bytes"] or 0) / shards)
    # Not more than 2 * shards / group_share groups can pass either bound.
    large = groups.where((F.col("n") > most_rows) | (F.col("n") * F.col("size") > most_bytes)).where(
        "n > 1"
    )
    parts = F.ceil(FINER * F.greatest(F.col("n") / most_rows, F.col("n") * F.col("size") / most_bytes))
    large = large.select(*group, parts.cast("int").alias("parts"))
    part = F.pmod(F.col("row"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(large), group, "left").withColumn("part", part).drop("parts")
    points = dealt.groupBy(*group, "part").agg(
        F.sum("size").alias("bytes"),
        F.min("length").cast("double").alias("length"),
        F.min("source").alias("source"),
        F.min("lang").alias("lang"),
        F.min("doc_id").cast("double").alias("doc_id"),
    )
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 31)).cast("double")
    return dealt, points.select(
        *group,
        "part",
        "bytes",
        F.log2(F.col("length") + 1).alias("x0"),
        hashed("source").alias("x1"),
        hashed("lang").alias("x2"),
        F.coalesce("doc_id", F.lit(0.0)).alias("x3"),
    )


def _keyed(points: DataFrame) -> tuple[DataFrame, list[float]]:
    """Points with a key k0, k1, ... for each dimension, at the root of the tree."""
    n = len(DIMENSIONS)
    edges = points.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)])
    e = edges.first()
    low = [e[f"min{i}"] or 0.0 for i in range(n)]
    width = [(e[f"max{i}"] or 0.0) - low[i] for i in range(n)]
    tie = F.pmod(F.xxhash64("hash", "text_crc32", "size", "part"), F.lit(1 << 32))
    key = lambda i: (
        F.shiftleft(
            F.floor((F.col(f"x{i}") - low[i]) * (((1 << 31) - 1) / width[i] if width[i] else 0.0)), 32
        )
        + tie
    )
    columns = ["hash", "text_crc32", "size", "part", "bytes"]
    keyed = points.select(*columns, *[key(i).alias(f"k{i}") for i in range(n)], F.lit(0).alias("node"))
    return keyed, width


def _own_key(dimension: str = "dimension"):
    return F.element_at(F.array(*[f"k{i}" for i in range(len(DIMENSIONS))]), F.col(dimension) + 1)


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table of one row per open node, as the right side of a join."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_SPLITS else table


def _choose_dimensions(points: DataFrame, nodes: dict[int, Node]) -> dict[int, int]:
    """Set each node's widest dimension; the bytes of each node."""
    n = range(len(DIMENSIONS))
    spread = [(F.max(F.shiftright(f"k{i}", 32)) - F.min(F.shiftright(f"k{i}", 32))).alias(f"w{i}") for i in n]
    found = points.groupBy("node").agg(F.sum("bytes").alias("bytes"), *spread).collect()
    for r in found:
        if r["node"] in nodes:
            nodes[r["node"]].dimension = max(n, key=lambda i: (r[f"w{i}"], -i))
    return {r["node"]: r["bytes"] for r in found}


def _find_splits(points: DataFrame, nodes: dict[int, Node], total: dict[int, int]) -> None:
    """Set each node's split to the key nearest to its weighted quantile."""
    spark = points.sparkSession
    prefix = dict.fromkeys(nodes, 0)
    below = dict.fromkeys(nodes, 0)  # bytes below the prefix
    shift = KEY_BITS
    open_ = set(nodes)
    wanted = {
        k: total[k] * ((x.high - x.low) // 2) / (x.high - x.low) for k, x in nodes.items()
    }
    while open_:
        before, shift = shift, max(0, shift - DIGIT_BITS)
        asked = [(k, nodes[k].dimension, prefix[k]) for k in sorted(open_)]
        joined = points.join(_small(spark, asked, "node int, dimension int, prefix long"), "node")
        joined = joined.withColumn("key", _own_key())
        digit = F.shiftright("key", shift)
        counted = (
            joined.where(F.shiftright("key", before) == F.col("prefix"))
            .groupBy("node", digit.alias("digit"))
            .agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        by_node: dict[int, list] = {k: [] for k in open_}
        for r in counted:
            by_node[r["node"]].append(r)
        for k in list(open_):
            for r in sorted(by_node[k], key=lambda r: r["digit"]):
                if below[k] + r["bytes"] < wanted[k]:
                    below[k] += r["bytes"]
                    continue
                if r["low"] == r["high"]:  # one point: to the side that comes out nearer
                    left_out, taken = wanted[k] - below[k], below[k] + r["bytes"] - wanted[k]
                    nodes[k].split = r["low"] if left_out <= taken else r["low"] + 1
                    open_.discard(k)
                prefix[k] = r["digit"]
                break
            else:
                raise AssertionError("the bytes of a node don't reach its quantile")


def assign_shards(docs: DataFrame, shards: int = 24, group_share: float = GROUP_SHARE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of `docs` (doc_id,
    text, source, lang).

    size is the text's UTF-8 bytes plus 8 (null text: 8). slot numbers a
    shard's rows from 0 without gaps. Null metadata is a value of its own; a
    null doc_id stays null. Equal texts share a shard unless their group is
    larger than `group_share` of a shard, in bytes or rows: such a group is dealt
    out row by row, whatever the ids, so that the shards' bytes come out even.
    Repeated rows each get a slot. With fewer
    texts than shards some shards stay empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows = staged(_sized(docs), "sizes")
    dealt, points = _points(rows, shards, group_share)
    dealt, points = staged(dealt, "sizes"), staged(points, "points")
    points = staged(_keyed(points)[0], "points")
    leaves: list[Node] = []
    level = {0: Node(0, 0, shards)}
    following = 1
    while level:
        leaves += [x for x in level.values() if x.high - x.low == 1]
        nodes = {k: x for k, x in level.items() if x.high - x.low > 1}
        total = _choose_dimensions(points, nodes) if nodes else {}
        nodes = {k: x for k, x in nodes.items() if total.get(k)}
        if not nodes:
            break
        _find_splits(points, nodes, total)
        level, moves = {}, []
        for k, x in nodes.items():
            middle = x.low + (x.high - x.low) // 2
            moves.append((k, x.dimension, x.split, following))
            level[following] = Node(following, x.low, middle)
            level[following + 1] = Node(following + 1, middle, x.high)
            following += 2
        table = _small(spark, moves, "node int, dimension int, split long, child int")
        moved = F.when(
            F.col("child").isNotNull(), F.col("child") + (_own_key() >= F.col("split")).cast("int")
        ).otherwise(F.col("node"))
        points = staged(
            points.join(table, "node", "left")
            .withColumn("node", moved)
            .drop("dimension", "split", "child"),
            "points",
        )
    named = _small(spark, [(x.number, x.low) for x in leaves], "node int, shard int")
    placed = points.join(named, "node").select("hash", "text_crc32", "size", "part", "shard")
    placed = dealt.join(placed, ["hash", "text_crc32", "size", "part"])
    return _numbered(placed.select("doc_id", "size", "text_crc32", "shard", "row"), shards)


def _numbered(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with a slot: numbered within parts of a shard that one task can hold."""
    rows = staged(rows, "placed")
    parts = 1 + rows.count() // (shards * NUMBERED)
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("row"), F.lit(parts)))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "piece")
        .agg(F.count("*").alias("n"))
        .select("shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "row")
    return (
        rows.withColumn("within", F.row_number().over(within) - 1)
        .join(starts, ["shard", "piece"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("within")).alias("slot"))
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """`docs` (unique doc_id) as one folder of Parquet files per shard."""
    placed = docs.join(assigned.select("doc_id", "shard"), "doc_id")
    placed.repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(8))).write.partitionBy(
        "shard"
    ).parquet(path)
