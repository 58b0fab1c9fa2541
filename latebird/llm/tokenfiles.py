"""Token-id files: every id in the fewest bits that the vocabulary needs.

Layout of a file, little-endian throughout:

    magic            8 bytes, b"LBTOKEN1"
    bit_width        uint32
    block_ids        uint32, ids in each block but the last
    blocks           each a bit string of its ids, first id in the lowest bits,
                     padded to whole bytes
    doc_ids          int64 x documents
    doc_known        uint8 x documents, 0 where the document has no id
    doc_starts       int64 x (documents + 1), in ids from the file's start
    block_offsets    int64 x (blocks + 1), in bytes from the file's start
    documents, blocks, footer_offset    int64 each
    magic            8 bytes

Because the width is fixed, any block unpacks with two numpy calls and any
range of ids is found from block_offsets alone (`read_ids`).

A corpus is one folder: files that hold ascending ranges of doc_id, and a
Parquet table `manifest` that names the files which count. A task writes under
a name of its own, so a repeated or speculative attempt never meets another's
file; the manifest is committed by Spark and lists one attempt per range.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latebird.llm.common import qualified, ship_package, text_or_empty
from latebird.llm.tokenizing import tokenizer

MAGIC = b"LBTOKEN1"
HEAD = struct.Struct("<8sII")
TAIL = struct.Struct("<qqq8s")
BLOCK_IDS = 65_536

MANIFEST_SCHEMA = "shard int, path string, n_docs long, n_ids long, n_bytes long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """The bits that the largest id needs."""
    if not 1 <= vocabulary <= 1 << 32:
        raise ValueError(f"no fixed width for a vocabulary of {vocabulary}")
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if width < 32 and ids.size and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):  # whole bytes: the same bit string without unpacking it
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def unpack_bits(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


class TokenFileWriter:
    """Writes documents one after another; holds one block and the index in memory."""

    def __init__(self, uri: str, width: int, block_ids: int = BLOCK_IDS):
        self.width, self.block_ids = width, block_ids
        system, path = _filesystem(uri)
        self._out = system.open_output_stream(path)
        self._out.write(HEAD.pack(MAGIC, width, block_ids))
        self._held: list[np.ndarray] = []
        self._held_ids = 0
        self._doc_ids: list[int] = []
        self._known: list[int] = []
        self._starts = [0]
        self._offsets = [HEAD.size]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._doc_ids.append(0 if doc_id is None else doc_id)
        self._known.append(doc_id is not None)
        self._starts.append(self._starts[-1] + len(ids))
        self._held.append(ids)
        self._held_ids += len(ids)
        if self._held_ids >= self.block_ids:
            self._write_blocks(last=False)

    def _write_blocks(self, last: bool) -> None:
        ids = np.concatenate(self._held) if self._held else np.empty(0, "<u4")
        stop = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for at in range(0, stop, self.block_ids):
            block = pack_bits(ids[at : min(stop, at + self.block_ids)], self.width)
            self._out.write(block)
            self._offsets.append(self._offsets[-1] + len(block))
        self._held = [ids[stop:]]
        self._held_ids = len(ids) - stop

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and bytes written."""
        self._write_blocks(last=True)
        footer = b"".join(
            (
                np.array(self._doc_ids, "<i8").tobytes(),
                np.array(self._known, np.uint8).tobytes(),
                np.array(self._starts, "<i8").tobytes(),
                np.array(self._offsets, "<i8").tobytes(),
                TAIL.pack(len(self._doc_ids), len(self._offsets) - 1, self._offsets[-1], MAGIC),
            )
        )
        self._out.write(footer)
        self._out.close()
        return len(self._doc_ids), self._starts[-1], self._offsets[-1] + len(footer)


class TokenFile:
    """Random access to a written file."""

    def __init__(self, uri: str):
        system, path = _filesystem(uri)
        self._in = system.open_input_file(path)
        magic, self.width, self.block_ids = HEAD.unpack(self._in.read_at(HEAD.size, 0))
        size = self._in.size()
        docs, blocks, footer, end = TAIL.unpack(self._in.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        index = self._in.read_at(size - TAIL.size - footer, footer)
        take = lambda kind, n, at: np.frombuffer(index, kind, n, at)
        self.doc_ids = take("<i8", docs, 0)
        self.doc_known = take(np.uint8, docs, 8 * docs)
        self.doc_starts = take("<i8", docs + 1, 9 * docs)
        self.block_offsets = take("<i8", blocks + 1, 9 * docs + 8 * (docs + 1))

    def close(self) -> None:
        self._in.close()

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop` of the file, reading only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        low, high = int(self.block_offsets[first]), int(self.block_offsets[last + 1])
        data = self._in.read_at(high - low, low)
        total = int(self.doc_starts[-1])
        parts = []
        for block in range(first, last + 1):
            at = int(self.block_offsets[block]) - low
            count = min(self.block_ids, total - block * self.block_ids)
            end = int(self.block_offsets[block + 1]) - low
            parts.append(unpack_bits(data[at:end], self.width, count))
        ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
        return ids[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self, span: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id, ids) of each document, reading about `span` ids at a time."""
        starts = self.doc_starts
        doc, count = 0, len(self.doc_ids)
        while doc < count:
            end = int(np.searchsorted(starts, starts[doc] + span, side="right")) - 1
            end = min(count, max(end, doc + 1))
            base = int(starts[doc])
            ids = self.read_ids(base, int(starts[end]))
            for i in range(doc, end):
                known = int(self.doc_ids[i]) if self.doc_known[i] else None
                yield known, int(starts[i]), ids[starts[i] - base : starts[i + 1] - base]
            doc = end


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_name: str = "word_bpe_49k.json",
    vocabulary: int = 49_408,
    end_id: int | None = 2,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode `docs` (doc_id, text) into token files in ascending doc_id order.

    Returns the committed manifest (shard, path, n_docs, n_ids, n_bytes). The
    rows are dealt by ranges of doc_id (then text hash and place, so that rows of
    one id need not share a file), so shards follow each other. A folder without a
    scheme is one of Spark's default file system. Null text is empty text: its document has the end id alone. A null doc_id sorts first
    and stays null. Rows with one doc_id stand side by side, by the hash of
    their text; equal rows are all written. Other columns are left out. An
    empty table gives no file and an empty manifest.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = qualified(spark, folder)
    width = bits_for(vocabulary)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_name).rows
        end = np.array([] if end_id is None else [end_id], "<u4")
        shard = TaskContext.get().partitionId()
        name = f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        writer = None
        for batch in batches:
            if writer is None and batch.num_rows:
                system, path = _filesystem(folder)
                system.create_dir(path, recursive=True)
                writer = TokenFileWriter(name, width, block_ids)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                writer.add(doc_id, np.concatenate((ids, end)))
        if writer is not None:
            n_docs, n_ids, n_bytes = writer.close()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([name]),
                    *(pa.array([n], pa.int64()) for n in (n_docs, n_ids, n_bytes)),
                ],
                names=["shard", "path", "n_docs", "n_ids", "n_bytes"],
            )

    ordered = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_or_empty().alias("text"),
            F.monotonically_increasing_id().alias("row"),
        )
        # Rows of one doc_id, or of none, are parted by text, and equal rows by place.
        .repartitionByRange("doc_id", F.xxhash64("text"), "row")
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "row")
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST_SCHEMA).write.parquet(manifest)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents
    before it, over all files), n_tokens, ids_crc32. A file is read by one task,
    a stretch of ids at a time."""
    ship_package(spark)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(  # one row per file: the only ordering over all
        "shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(path)
                rows: list[tuple] = []
                for doc_id, start, ids in file.documents():
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.tobytes())))
                    if len(rows) == 10_000:
                        yield _read_batch(rows)
                        rows = []
                if rows:
                    yield _read_batch(rows)
                file.close()

    files = max(1, manifest.count())
    dealt = placed.repartition(files, "shard").select("path", "base")
    return dealt.mapInArrow(read, READ_SCHEMA)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, names=names)
