"""Vector bin packing of examples into training sequences.

An example is a run of token ids; what comes after its prompt bears loss. A
sequence is a bin with three limits at once: tokens, segments (pieces) and
loss-bearing tokens. Bins are filled one at a time. Of the pieces that fit, the
one goes in whose demand has the largest dot product with what the bin has left,
both as shares of the limits; so a bin short of loss takes prompts, and a bin
short of segments takes long pieces. When nothing fits whole, a piece is cut.

Each task packs the examples of its own input split: nothing is shuffled. It
holds a pool of at most `POOL` open pieces, and what is left at the end of the
split goes into sequences whose lengths are powers of two.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, text_or_empty
from latebird.llm.tokenizing import tokenizer

#: Open pieces held in a task before bins are closed, and how many stay for choice.
POOL = 4_096
STAY = 2_048
#: Sequence numbers of one task; the task's number stands above these bits.
TASK_BITS = 40

PIECES_SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, loss_tokens long, "
    "sequence_id long, offset long, ids binary"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")


@dataclass
class Piece:
    """Ids `start` to `start + length` of a document of `doc_tokens` ids."""

    doc_id: int | None
    start: int
    ids: memoryview  # 4 bytes an id
    doc_tokens: int
    loss_from: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def loss(self, length: int | None = None) -> int:
        end = self.start + (self.length if length is None else length)
        return max(0, end - max(self.start, self.loss_from))

    @property
    def lead(self) -> int:
        """How many leading ids bear no loss."""
        return min(self.length, max(0, self.loss_from - self.start))

    def longest(self, tokens: int, loss: int) -> int:
        """The most leading ids that keep within `tokens` and `loss`."""
        return min(self.length, tokens, self.lead + loss)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * length], self.doc_tokens, self.loss_from)
        rest = Piece(
            self.doc_id, self.start + length, self.ids[4 * length :], self.doc_tokens, self.loss_from
        )
        return head, rest


class Packer:
    """Turns pieces into sequences: lists of pieces within the limits."""

    def __init__(self, limits: Limits, pool: int = POOL, stay: int = STAY):
        self.limits, self.stay = limits, stay
        self._pieces: list[Piece | None] = [None] * pool
        self._tokens = np.zeros(pool, np.int64)  # 0: the place is free
        self._loss = np.zeros(pool, np.int64)
        self._lead = np.zeros(pool, np.int64)  # leading ids without loss
        self._free = list(range(pool - 1, -1, -1))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        limits = self.limits
        while piece.length:
            fits = piece.longest(limits.tokens, limits.loss_tokens)
            if fits < limits.tokens and fits == piece.length:
                break
            head, piece = piece.cut(fits)
            if fits == limits.tokens:
                yield [head]
            else:  # the loss limit cut it short: it still can take other pieces along
                yield from self._put(head)
        if piece.length:
            yield from self._put(piece)

    def _put(self, piece: Piece) -> Iterator[list[Piece]]:
        self._set(self._free.pop(), piece)
        if not self._free:
            while len(self._pieces) - len(self._free) > self.stay:
                yield from self._close(self._fill())

    def _close(self, taken: list[Piece]) -> Iterator[list[Piece]]:
        if sum(p.length for p in taken) == self.limits.tokens:
            yield taken
        else:
            yield from powers_of_two(taken)

    def _set(self, place: int, piece: Piece | None) -> None:
        self._pieces[place] = piece
        self._tokens[place] = piece.length if piece else 0
        self._loss[place] = piece.loss() if piece else 0
        self._lead[place] = piece.lead if piece else 0
        if piece is None:
            self._free.append(place)

    def _fill(self) -> list[Piece]:
        """Fill one bin from the pool."""
        cap = self.limits
        tokens, segments, loss = cap.tokens, cap.segments, cap.loss_tokens
        taken: list[Piece] = []
        while tokens and segments and len(self._free) < len(self._pieces):
            dots = self._tokens * (tokens / cap.tokens**2) + self._loss * (loss / cap.loss_tokens**2)
            dots += segments / cap.segments**2  # every piece is one segment
            open_ = self._tokens > 0
            whole = open_ & (self._tokens <= tokens) & (self._loss <= loss)
            if segments == 1:  # the last place: what fills the bin, if need be by a cut
                filling = open_ & (self._tokens >= tokens) & (self._loss >= 0)
                whole = whole & (self._tokens == tokens) if filling.any() else whole
            if whole.any():
                place = int(np.argmax(np.where(whole, dots, -1.0)))
                piece = self._pieces[place]
                self._set(place, None)
            else:
                fits = np.minimum(np.minimum(self._tokens, tokens), self._lead + loss)
                place = int(np.argmax(np.where(fits > 0, dots, -1.0)))
                if fits[place] <= 0:
                    break  # only loss-bearing ids are left, and no loss fits any more
                piece, rest = self._pieces[place].cut(int(fits[place]))
                self._set(place, rest if rest.length else None)
            taken.append(piece)
            tokens, segments, loss = tokens - piece.length, segments - 1, loss - piece.loss()
        return taken

    def finish(self) -> Iterator[list[Piece]]:
        while len(self._free) < len(self._pieces):
            yield from self._close(self._fill())


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces of a bin that isn't full, as sequences that need no padding."""
    left = sum(p.length for p in pieces)
    queue = list(reversed(pieces))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        taken = []
        while room:
            piece = queue.pop()
            if piece.length > room:
                piece, rest = piece.cut(room)
                queue.append(rest)
            taken.append(piece)
            room -= piece.length
        yield taken


def first_line() -> Column:
    """The prompt of a plain document: its text up to the first line end, without
    blanks before that; empty where no line ends."""
    text = text_or_empty()
    line = F.rtrim(F.substring_index(text, "\n", 1), F.lit(" \t\r\v\f"))
    return F.when(F.contains(text, F.lit("\n")), line).otherwise(F.lit(""))


def pack_documents(
    docs: DataFrame,
    limits: Limits = Limits(),
    tokenizer_name: str = "byte_bpe_50k.json",
    end_id: int | None = 1,
    loss_from: Column | None = None,
    prompt: Column | None = None,
) -> DataFrame:
    """Pack `docs` (doc_id, text) into sequences; one row per piece, with its ids.

    `loss_from`: the first loss-bearing id of a document (an instruction's
    prompt length). Or `prompt`: the text at a document's beginning whose ids, as
    many as it has by itself, bear no loss. By default and where null every id
    bears loss. Sequence
    lengths are `limits.tokens` or a power of two: a bin that another limit
    closes early is split so. Null text is empty: the document has its end
    id alone (without an end id, no piece). A null doc_id stays null; repeated
    rows are packed each for itself; other columns are left out; an empty table
    gives an empty result. `sequence_id` is unique, not gapless.
    """
    if loss_from is not None and prompt is not None:
        raise ValueError("give loss_from or prompt, not both")
    ship_package(docs.sparkSession)
    by_prompt = prompt is not None

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_name).rows
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        packer = Packer(limits)
        out = _Rows(TaskContext.get().partitionId() << TASK_BITS)
        for batch in batches:
            before = batch.column(2)
            firsts = [len(ids) for ids in encode(before)] if by_prompt else before.to_pylist()
            for doc_id, first, own in zip(batch.column(0).to_pylist(), firsts, encode(batch.column(1))):
                ids = memoryview(own.tobytes() + end)
                piece = Piece(doc_id, 0, ids, len(ids) // 4, first)
                for sequence in packer.add(piece):
                    yield from out.add(sequence)
        for sequence in packer.finish():
            yield from out.add(sequence)
        yield from out.flush()

    if by_prompt:
        before = F.coalesce(prompt.cast("string"), F.lit(""))
    else:
        before = F.lit(0) if loss_from is None else F.coalesce(loss_from, F.lit(0))
        before = F.greatest(before, F.lit(0)).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        before.alias("before"),
    ).mapInArrow(pack, PIECES_SCHEMA)


class _Rows:
    """Gathers sequences into Arrow batches of a few MB."""

    def __init__(self, first_sequence: int):
        self.sequence = first_sequence
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, pieces: list[Piece]) -> Iterator[pa.RecordBatch]:
        offset = 0
        for p in pieces:
            self.rows.append(
                (p.doc_id, p.start, p.length, p.doc_tokens, p.loss(), self.sequence, offset, p.ids)
            )
            offset += p.length
            self.bytes += len(p.ids)
        self.sequence += 1
        if self.bytes > 4 << 20 or len(self.rows) > 20_000:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            *numbers, ids = zip(*self.rows)
            columns = [pa.array(c, pa.int64()) for c in numbers]
            columns.append(pa.array([bytes(x) for x in ids], pa.binary()))
            names = [c.split()[0] for c in PIECES_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        self.rows, self.bytes = [], 0
