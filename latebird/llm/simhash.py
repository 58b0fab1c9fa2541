"""SimHash fingerprints, and their links by pigeonring filtering.

A fingerprint has 64 bits; two link if at most 4 differ. The bits are dealt to
5 segments in a ring. If the differences sum to at most 4, some segment starts a
chain in which the first l segments differ in at most floor(l * 4 / 5) bits, for
every l: 0, 1, 2, 3 (the pigeonring principle). So a pair is sought only where
one segment is equal and the next differs in at most one bit (a key of about 26
bits), the chains of three and four segments prune it further, and what is left
gets the full check.

To meet at such a key, a fingerprint whose second segment has an even number of
ones gives that segment's value alone, an odd one gives its value and all values
one bit away: equal segments meet, and two that differ in one bit have different
parity. That is 37.5 rows for each distinct fingerprint on average.

Rows of one key are compared by a task in a sorted stream, as one lag after
another over whole batches, and leave a spanning forest instead of all pairs. A
key with more than `RUN` fingerprints is dealt out in pairs of blocks, so it is
compared in full by many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, staged, text_or_empty, unused_name
from latebird.llm.components import stars

WORDS_PER_SHINGLE = 4
SEED = 42
MOST_DIFFERENT = 4
#: Segments of the ring as (lowest bit, bits).
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
KEY_BITS = 26
#: Most fingerprints of a key compared in one stream, and rows of a block beyond.
RUN = 4_096
BLOCK = 2_048
#: Rows gathered before a task compares, and bytes of text hashed at once.
GATHERED = 500_000
STRETCH = 4 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _chain_masks() -> np.ndarray:
    """[first segment, length - 1] -> the bits of the chain."""
    masks = np.zeros((len(SEGMENTS), len(SEGMENTS)), np.uint64)
    for first in range(len(SEGMENTS)):
        bits = 0
        for length in range(len(SEGMENTS)):
            low, count = SEGMENTS[(first + length) % len(SEGMENTS)]
            bits |= ((1 << count) - 1) << low
            masks[first, length] = bits
    return masks


CHAINS = _chain_masks()


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a stretch at a time."""
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + STRETCH) if start + STRETCH < len(data) else None
        end = gap.start() if gap else len(data)
        yield data[start:end].split()  # bytes.split() parts at exactly these six signs
        start = end


def fingerprint(data: bytes) -> int:
    """The fingerprint of a text in UTF-8."""
    ones = np.zeros((8, 8), np.int64)  # byte of the hash, bit of the byte
    n = 0
    held: list[bytes] = []

    def count(shingles: list[bytes]) -> None:
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
        columns = np.frombuffer(digests, np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(columns[:, k], minlength=256) @ _BITS

    k = WORDS_PER_SHINGLE
    for words in _word_lists(data.lower()):  # bytes.lower() changes A-Z alone
        words = held + words
        if len(words) >= k:
            line = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
            ends = (starts + lengths)[k - 1 :].tolist()
            count([line[a:b] for a, b in zip(starts.tolist(), ends)])
            n += len(ends)
            held = words[1 - k :]
        else:
            held = words
    if not n and held:
        count([b" ".join(held)])
        n = 1
    return int.from_bytes(np.packbits((2 * ones > n).ravel()).tobytes()) if n else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id long, fp long) for every row of `docs` (doc_id, text)."""
    ship_package(docs.sparkSession)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter(
                (fingerprint(t.as_buffer().to_pybytes()) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    ).mapInArrow(hashed, "doc_id long, fp long")


def _keys(fp: str) -> F.Column:
    """The keys under which a fingerprint meets others, in all chains."""
    part = lambda i: F.shiftrightunsigned(fp, SEGMENTS[i][0]).bitwiseAND((1 << SEGMENTS[i][1]) - 1)
    lists = []
    for first in range(len(SEGMENTS)):
        second = (first + 1) % len(SEGMENTS)
        value = part(second)
        base = F.lit(first << KEY_BITS) + F.shiftleft(part(first), 13)
        near = [value.bitwiseXOR(F.lit(1 << b)) for b in range(SEGMENTS[second][1])]
        odd = F.bit_count(value) % 2 == 1
        lists.append(
            F.when(odd, F.array(base + value, *(base + x for x in near))).otherwise(
                F.array(base + value)
            )
        )
    return F.concat(*lists)


def linked(first: np.ndarray, second: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Positions at which the pairs pass the chains of `chain` and the full check."""
    different = first ^ second
    keep = np.arange(len(different))
    for length in (3, 4, 5):  # chains of one and two segments are the key
        mask = CHAINS[chain[keep], length - 1]
        most = length * MOST_DIFFERENT // len(SEGMENTS)
        keep = keep[np.bitwise_count(different[keep] & mask) <= most]
    return keep


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that keep the components of the given ones: (node, smallest node)."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key; the rows are sorted by key."""
    bits = fp.view(np.uint64)
    chain = (key >> KEY_BITS).astype(np.int64)
    alive = np.arange(len(key))
    found_a, found_b = [], []
    lag = 1
    while True:
        alive = alive[alive + lag < len(key)]
        alive = alive[key[alive + lag] == key[alive]]
        if not len(alive):
            break
        hits = alive[linked(bits[alive], bits[alive + lag], chain[alive])]
        if len(hits):
            found_a.append(fp[hits])
            found_b.append(fp[hits + lag])
        lag += 1
    if not found_a:
        return fp[:0], fp[:0]
    return forest(np.concatenate(found_a), np.concatenate(found_b))


_LINKS_SCHEMA = "a long, b long, key long"


def _link_batch(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
    empty = pa.nulls(len(a), pa.int64())
    columns = [pa.array(a, pa.int64())]
    columns.append(empty if b is None else pa.array(b, pa.int64()))
    columns.append(empty if key is None else pa.array(key, pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "key"])


def _compare_stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b); rows of a key with more than RUN fingerprints come out as (a, null, key)."""
    keys: list[np.ndarray] = []
    fps: list[np.ndarray] = []
    hot: int | None = None  # a key already known to be too large

    def compared(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        nonlocal hot
        if not len(key):
            return
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        large = sizes > RUN
        if hot is not None:
            large |= key[starts] == hot
        rows = np.repeat(large, sizes)
        if rows.any():
            yield _link_batch(fp[rows], None, key[rows])
        a, b = _compare_runs(key[~rows], fp[~rows])
        if len(a):
            yield _link_batch(a, b, None)

    gathered = 0
    for batch in batches:
        keys.append(batch.column(0).to_numpy())
        fps.append(batch.column(1).to_numpy())
        gathered += batch.num_rows
        if gathered < GATHERED:
            continue
        key, fp = np.concatenate(keys), np.concatenate(fps)
        cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
        yield from compared(key[:cut], fp[:cut])
        if hot != key[-1]:
            hot = None
        if len(key) - cut > RUN or hot == key[-1]:
            hot = int(key[-1])
            yield _link_batch(fp[cut:], None, key[cut:])
            cut = len(key)
        keys, fps, gathered = [key[cut:]], [fp[cut:]], len(key) - cut
    if keys:
        yield from compared(np.concatenate(keys), np.concatenate(fps))


def _compare_blocks(rows: pa.Table) -> pa.Table:
    """Links within one pair of blocks of a hot key."""
    fp = rows.column("a").to_numpy()
    chain = int(rows.column("key")[0].as_py()) >> KEY_BITS
    bits = fp.view(np.uint64)
    found_a, found_b = [], []
    for i in range(len(fp) - 1):
        hits = linked(
            np.broadcast_to(bits[i], len(fp) - i - 1),
            bits[i + 1 :],
            np.broadcast_to(chain, len(fp) - i - 1),
        )
        if len(hits):
            found_a.append(np.full(len(hits), fp[i]))
            found_b.append(fp[i + 1 + hits])
    a, b = (np.concatenate(x) if x else fp[:0] for x in (found_a, found_b))
    if len(a):
        a, b = forest(a, b)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(fps: DataFrame) -> DataFrame:
    """`fps` (fp long, distinct) -> distinct (a, b), a > b: links that keep every component."""
    ship_package(fps.sparkSession)
    keyed = fps.select(F.explode(_keys("fp")).alias("key"), "fp")
    compared = staged(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_compare_stream, _LINKS_SCHEMA),
        "links",
    )
    near = compared.where("key IS NULL").select("a", "b")
    hot = compared.where("key IS NOT NULL").select("a", "key")
    blocks = hot.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    dealt = (
        hot.join(blocks, "key")
        .withColumn("own", F.pmod(F.xxhash64("a"), F.col("n")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("a", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )
    in_blocks = dealt.groupBy("key", "x", "y").applyInArrow(_compare_blocks, "a long, b long")
    both = near.union(in_blocks)
    return both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, the row's own
    included. Null and wordless texts have fingerprint 0 and link like others.
    Rows with a null doc_id are linked too; a component of such rows alone has
    a null component_id. Repeated rows each give a row. Other columns are not
    looked at; an empty table gives an empty result.
    """
    fps = staged(fingerprints(docs), "fingerprints")
    groups = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("d")), "fingerprint-groups")
    roots = stars(links(groups.select("fp")))
    placed = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "d", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("d").alias("component_id"))
    of_fp = placed.join(named, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: str = "fp") -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without all but one of each group of near copies: the
    one with the smallest doc_id stays. Of rows that repeat a doc_id and its text
    one stays; rows that give a doc_id another text cannot be told apart by it and
    stay or go together. Rows with a null doc_id cannot be named and stay as they
    are. All columns are kept."""
    named = docs.where("doc_id IS NOT NULL")
    marker = unused_name(docs, "kept_id")
    kept = (
        simhash_components(named)
        .where("doc_id = component_id")
        .select(F.col("doc_id").alias(marker))
        .distinct()
    )
    once = named.join(kept, F.col("doc_id").cast("long") == F.col(marker), "left_semi")
    return once.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
