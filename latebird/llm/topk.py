"""Exact top-k inner products: norm order, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are rotated to the principal axes of all vectors (the eigenvectors of
their summed outer products, from one distributed pass), so that the first
coordinates hold most of every inner product. For a query q and a vector c

    q.c <= (sum over the first p axes) + |rest of q| |rest of c|

bounds what the remaining axes can add. Vectors are met in descending length, so
a query is done as soon as |q| |c| falls below its k-th best score. The bounds
are in floating point with a margin; scores of what they leave are exact.

The `HEAD` longest vectors are met first, by every query, and set a floor under
its k-th score: only vectors of at least floor / |q| can still matter to it. Then
vectors are cut by their length into slabs of bounded size, the longest first,
and queries by the length they ask for into chunks. A chunk meets a slab, as one
group, only if some vector of the slab may be long enough for some query of the
chunk; rows are sent to no other group. A group returns its k best rows for each
query.

Lengths are counted in bands of a hundredth of their logarithm, so that the
driver sees a few thousand counts at most, whatever the number of vectors. Small
bands side by side make one slab; a band of many equal lengths is dealt to
several by hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, staged

#: Queries in a chunk, vectors in a slab, longest vectors met first, vectors at a time.
CHUNK = 2_048
SLAB = 8_192
HEAD = 1_024
STEP = 512
#: Shares of the axes after which pairs are pruned.
PARTS = (0.125, 0.25, 0.5)
#: Bands of length in each step of the natural logarithm.
BANDS = 100
#: Components beyond which a vector is taken for a mistake: the axes are a square of this side.
MOST_WIDTH = 2_048

_ASKED = "row long, vec_id long, v array<double>, floor double, need double"
_FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, v, norm) of the rows that take part: v = floor(scale * x)."""
    usable = F.expr(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL "
        "AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    floored = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x, F.sqrt)
    return (
        vectors.where(F.coalesce(usable, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), floored.alias("v"))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", length.alias("norm"))
    )


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column) or not width:
        return np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """The axes, the strongest first, from all rows of `vectors` (v)."""

    def outer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            total += m.T @ m
        places = np.arange(width * width, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(total.ravel())], names=["place", "value"]
        )

    sums = vectors.select("v").mapInArrow(outer, "place int, value double")
    added = sums.groupBy("place").agg(F.sum("value").alias("value")).toArrow()  # width^2 rows
    total = np.zeros(width * width)
    total[added.column("place").to_numpy()] = added.column("value").to_numpy()
    return np.linalg.eigh(total.reshape(width, width))[1][:, ::-1].copy()


class Search:
    """The k best of vectors met block by block, each once, for a set of queries.
    What scores below a query's `floor` is of no interest to it."""

    def __init__(
        self,
        rows: np.ndarray,
        queries: np.ndarray,
        axes: np.ndarray,
        k: int,
        floor: np.ndarray | None = None,
    ):
        self.rows, self.queries, self.axes, self.k = rows, queries, axes, k
        self.rotated = queries @ axes
        self.norms = np.sqrt((queries**2).sum(axis=1))
        self.cuts = sorted({max(1, int(len(axes) * p)) for p in PARTS if len(axes)})
        self.rests = [self._rest(self.rotated, cut) for cut in self.cuts]
        n = len(queries)
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.zeros((n, k), np.int64)
        self.cand_rows = np.zeros((n, k), np.int64)
        self.filled = np.zeros(n, np.int64)
        self.floor = np.full(n, -np.inf) if floor is None else floor.copy()

    @staticmethod
    def _rest(rotated: np.ndarray, cut: int) -> np.ndarray:
        return np.sqrt((rotated[:, cut:] ** 2).sum(axis=1))

    def meet(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compare with `vectors`, which come in descending length."""
        rotated = vectors @ self.axes
        norms = np.sqrt((vectors**2).sum(axis=1))
        rests = [self._rest(rotated, cut) for cut in self.cuts]
        for at in range(0, len(vectors), STEP):
            block = slice(at, at + STEP)
            margin = 1e-9 * (1.0 + self.norms * norms[at])
            live = np.flatnonzero(self.norms * norms[at] + margin >= self.floor)
            if not len(live):
                break
            self._meet_block(live, margin[live], block, rows, ids, vectors, rotated, rests)

    def _meet_block(self, live, margin, block, rows, ids, vectors, rotated, rests) -> None:
        floor = (self.floor[live] - margin)[:, None]
        sums, done, q, c = 0.0, 0, None, None
        for cut, own, other in zip(self.cuts, self.rests, rests):
            if q is None:
                sums = sums + self.rotated[live, done:cut] @ rotated[block, done:cut].T
                keep = sums + np.outer(own[live], other[block]) >= floor
                if keep.mean() < 0.1:  # from here on pair by pair
                    q, c = np.nonzero(keep)
                    sums = sums[q, c]
            else:
                x, y = self.rotated[live[q], done:cut], rotated[block][c, done:cut]
                sums = sums + np.einsum("ij,ij->i", x, y)
                keep = sums + own[live[q]] * other[block][c] >= floor[q, 0]
                q, c, sums = q[keep], c[keep], sums[keep]
            done = cut
        if q is None:
            q, c = np.nonzero(np.broadcast_to(True, (len(live), len(rows[block]))))
            exact = _products(self.queries[live], vectors[block]).ravel()
        else:
            exact = _products_of_pairs(self.queries[live[q]], vectors[block][c])
        q = live[q]
        good = (exact >= self.floor[q]) & (self.rows[q] != rows[block][c])
        q, c, exact = q[good], c[good], exact[good]
        if not len(q):
            return
        ids, rows = ids[block][c], rows[block][c]
        starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        for a, b in zip(starts, np.append(starts[1:], len(q))):
            self._take(int(q[a]), exact[a:b], ids[a:b], rows[a:b])

    def _take(self, q: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        n = self.filled[q]
        scores = np.concatenate((self.scores[q, :n], scores))
        ids = np.concatenate((self.ids[q, :n], ids))
        rows = np.concatenate((self.cand_rows[q, :n], rows))
        best = np.lexsort((ids, -scores))[: self.k]
        n = len(best)
        self.scores[q, :n], self.ids[q, :n], self.cand_rows[q, :n] = scores[best], ids[best], rows[best]
        self.filled[q] = n
        if n == self.k:  # the k-th best score so far
            self.floor[q] = max(self.floor[q], self.scores[q, n - 1])

    def found(self, query_ids: np.ndarray) -> pa.Table:
        q = np.repeat(np.arange(len(self.rows)), self.filled)
        slot = np.concatenate([np.arange(n) for n in self.filled]) if len(q) else q
        columns = [self.rows[q], query_ids[q], self.cand_rows[q, slot]]
        columns += [self.ids[q, slot], self.scores[q, slot]]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _exact_in_floats(a: np.ndarray, b: np.ndarray) -> bool:
    largest = np.sqrt((a**2).sum(axis=1).max() * (b**2).sum(axis=1).max())
    if largest >= 2.0**62:
        raise ArithmeticError("a score doesn't fit a long")
    return largest < 2.0**52 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 2.0**26


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if _exact_in_floats(a, b):  # every partial sum is a whole number below 2^53
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _products_of_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a):
        return np.zeros(0, np.int64)
    if _exact_in_floats(a, b):
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))


@dataclass
class Stretch:
    """Neighbouring bands of a length, and the blocks their rows are dealt to."""

    bands: list[int]
    n: int
    low: float
    high: float
    first: int = 0
    pieces: int = 1


def _band(column: str) -> Column:
    """The band of a length; lengths below 1 are one band."""
    band = F.floor(F.ln(column) * BANDS).cast("int")
    return F.when(F.col(column) >= 1, band).otherwise(F.lit(-1))


def stretches(rows: DataFrame, column: str, size: int) -> list[Stretch]:
    """The bands of `column`, the highest first, joined up to `size` rows; a larger
    band stands by itself and has several blocks."""
    counts = rows.groupBy(_band(column).alias("band")).agg(
        F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
    )
    out: list[Stretch] = []
    for r in sorted(counts.collect(), key=lambda r: -r["band"]):
        if out and out[-1].n + r["n"] <= size:
            last = out[-1]
            last.bands.append(r["band"])
            last.n, last.low = last.n + r["n"], r["low"]
        else:
            out.append(Stretch([r["band"]], r["n"], r["low"], r["high"]))
    first = 0
    for s in out:
        s.first, s.pieces = first, -(-s.n // size)
        first += s.pieces
    return out


def _dealt(
    rows: DataFrame, column: str, parts: list[Stretch], partners: list[tuple[int, int]], own: str, other: str
) -> DataFrame:
    """`rows` with the block of each (`own`), once for each block it meets (`other`)."""
    bands = [
        (band, s.first, s.pieces, low, high)
        for s, (low, high) in zip(parts, partners)
        if low <= high
        for band in s.bands
    ]
    table = rows.sparkSession.createDataFrame(bands, "band int, first int, pieces int, low int, high int")
    block = F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces"))
    return rows.join(F.broadcast(table), _band(column) == F.col("band")).select(
        block.cast("int").alias(own), F.explode(F.sequence("low", "high")).alias(other), *rows.columns
    )


def blocks(asked: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`asked` (row, need, ...) and `rows` (row, norm, ...), each row once for every
    (chunk, slab) it takes part in: those where some norm reaches some need."""
    chunks, slabs = stretches(asked, "need", CHUNK), stretches(rows, "norm", SLAB)
    # Both fall, so that a chunk meets the first slabs and a slab the last chunks.
    last_slab = [
        max((t.first + t.pieces - 1 for t in slabs if t.high >= s.low), default=-1) for s in chunks
    ]
    last_chunk = chunks[-1].first + chunks[-1].pieces - 1
    first_chunk = [
        min((s.first for s in chunks if t.high >= s.low), default=last_chunk + 1) for t in slabs
    ]
    return (
        _dealt(asked, "need", chunks, [(0, last) for last in last_slab], "chunk", "slab"),
        _dealt(rows, "norm", slabs, [(first, last_chunk) for first in first_chunk], "slab", "chunk"),
    )


def with_floors(
    queries: DataFrame, head: pa.Table, axes: np.ndarray, width: int, k: int
) -> DataFrame:
    """`queries` (row, vec_id, v) with `floor`, the k-th best score among the longest
    vectors, and `need`, the length below which no vector can reach it."""
    head_rows, head_ids = (head.column(c).to_numpy() for c in ("row", "vec_id"))
    longest = _matrix(head.column("v"), width)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                row = part.column(0).to_numpy()
                q = Search(row, _matrix(part.column(2), width), axes, k)
                q.meet(head_rows, head_ids, longest)
                # A query of length 0 has a floor of 0 at most, which any length reaches.
                need = np.maximum(q.floor, 0.0) / np.maximum(q.norms, 1.0) * (1 - 1e-9)
                columns = [part.column(0), part.column(1), part.column(2), q.floor, need]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _ASKED.split(", ")])

    return queries.select("row", "vec_id", "v").mapInArrow(meet, _ASKED)


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, most_width: int = MOST_WIDTH
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `vectors` (vec_id,
    embedding) with `is_query` (over vec_id), its k highest scores among all
    other rows, ties to the smaller vec_id; all of them if there are fewer.

    Rows with a null vec_id take no part, nor vectors that are null or hold null
    or non-finite components. Vectors of different lengths are compared over
    the shorter's components; an empty vector scores 0. A vector of more than
    `most_width` components raises an error. Repeated rows are rows of their own,
    as queries and as candidates. A score beyond a long raises an error. Other
    columns are not looked at; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = staged(integer_vectors(vectors, scale), "vectors")
    width = rows.agg(F.max(F.size("v")).alias("width")).first()["width"] or 0
    if width > most_width:
        raise ValueError(f"a vector has {width} components, more than {most_width}")
    axes = principal_axes(rows, width) if width else np.zeros((0, 0))
    head = rows.orderBy(F.desc("norm"), "row").limit(HEAD).toArrow()  # HEAD rows at most
    queries = rows.where(F.coalesce(is_query, F.lit(False)))
    asked = staged(with_floors(queries, head, axes, width, k), "queries")
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def search(asked: pa.Table, given: pa.Table) -> pa.Table:
        of = lambda table, name: table.column(name).to_numpy()
        q = Search(of(asked, "row"), _matrix(asked.column("v"), width), axes, k, of(asked, "floor"))
        if asked.num_rows:
            given = given.take(np.argsort(-of(given, "norm"), kind="stable"))
            q.meet(of(given, "row"), of(given, "vec_id"), _matrix(given.column("v"), width))
        return q.found(of(asked, "vec_id"))

    asked, given = blocks(asked, rows)
    found = (
        asked.groupBy("chunk", "slab")
        .cogroup(given.groupBy("chunk", "slab"))
        .applyInArrow(search, _FOUND)
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
