"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are the same)
that no neighbouring word extends, of at least `LEAST` words and `TIMES` periods.

At scale L, a power of two, words are cut into blocks of L. A run with a period
from L to 2L - 1 and four periods holds a whole block within its first 2L - 1
words, with the block's copies one and two periods on. So for every block the
distances from L to 2L - 1 are looked for at which the following window shows
the block without a mismatch: the sum of squared differences is

    sum x^2 - 2 sum x y + sum y^2

where the middle sum, for all distances at once, is a cyclic convolution of
length 2L by a number-theoretic transform over whole numbers modulo a prime, for
many blocks together. A block without mismatch always has the sum 0. The sum is
known modulo the prime, so each 0 is a seed only: the words themselves are then
compared over two periods, and from there the run is extended to both sides.

Two exact rules spare transforms. A block can only match if each of its words
occurs four times in the text and again within the window. And where a block
lies in a run already found, at a smaller scale, the copies within that run
belong to it: two runs that share a stretch of the sum of their periods are one.
Only distances that lead out of the run are kept then.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, text_or_empty

#: A run's least words and least periods; the search needs four periods.
LEAST = 6
TIMES = 4
#: 119 * 2^23 + 1, with 3 as a primitive root: transforms of up to 2^23 places.
PRIME = 998_244_353
ROOT = 3
#: Bytes of text handled at once, at least one text; places transformed at once.
STRETCH = 4 << 20
PLACES = 1 << 20
#: Up to this scale a word's return within the window is looked up by comparing shifts.
SHIFTS = 8

RUNS_SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

_powers: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, back: bool) -> np.ndarray:
    """The first `half` powers of a root of unity of order 2 * half, or of its inverse."""
    if (half, back) not in _powers:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, PRIME - 2, PRIME) if back else root
        powers = np.ones(half, np.uint64)
        known = 1
        while known < half:
            more = min(known, half - known)
            powers[known : known + more] = powers[:more] * np.uint64(pow(root, known, PRIME)) % PRIME
            known += more
        _powers[half, back] = powers
    return _powers[half, back]


def _transform(a: np.ndarray) -> np.ndarray:
    """Each row's transform, in bit-reversed order; rows have a power of two of places."""
    rows, n = a.shape
    half = n // 2
    while half:
        v = a.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        total = (low + high) % PRIME
        v[:, :, 1] = (low + PRIME - high) * _twiddles(half, False) % PRIME
        v[:, :, 0] = total
        half //= 2
    return a


def _transform_back(a: np.ndarray) -> np.ndarray:
    rows, n = a.shape
    half = 1
    while half < n:
        v = a.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0].copy(), v[:, :, 1] * _twiddles(half, True) % PRIME
        v[:, :, 0] = (low + high) % PRIME
        v[:, :, 1] = (low + PRIME - high) % PRIME
        half *= 2
    return a * np.uint64(pow(n, PRIME - 2, PRIME)) % PRIME


def mismatch_free(words: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks of `block` words at `starts` whose words, taken
    modulo the prime, have squared differences of sum 0 to those `distance` on,
    for distances from `block` to twice that, exclusive. `words` are numbers below
    the prime; places past the end match nothing."""
    found_at, found_distance = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    each = max(1, PLACES // (2 * block))
    window = np.arange(2 * block - 1) + block
    for at in range(0, len(starts), each):
        own = starts[at : at + each]
        x = words[own[:, None] + np.arange(block)]
        places = own[:, None] + window
        y = np.where(places < len(words), words[np.minimum(places, len(words) - 1)], PRIME - 1)
        squares = np.cumsum(y * y % PRIME, axis=1)  # below 2^30 each: no overflow below 2^34 places
        last = squares[:, block - 1 :]
        y2 = last.copy()
        y2[:, 1:] -= squares[:, : block - 1]
        x2 = (x * x % PRIME).sum(axis=1, keepdims=True)
        a = np.zeros((len(own), 2 * block), np.uint64)
        a[:, 0] = x[:, 0]
        a[:, block + 1 :] = x[:, :0:-1]
        b = np.zeros((len(own), 2 * block), np.uint64)
        b[:, : 2 * block - 1] = y
        middle = _transform_back(_transform(a) * _transform(b) % PRIME)[:, :block]
        row, shift = np.nonzero((x2 + y2) % PRIME == 2 * middle % PRIME)
        found_at.append(own[row])
        found_distance.append(shift + block)
    return np.concatenate(found_at), np.concatenate(found_distance)


class _Returns:
    """Where a word comes again: all places sorted by text, word and place."""

    def __init__(self, words: np.ndarray, texts: np.ndarray):
        n = len(words)
        key = texts * (words.max() + 1) + words
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        groups = np.cumsum(new) - 1
        self.group = np.empty(n, np.int64)
        self.group[order] = groups
        sizes = np.diff(np.append(np.flatnonzero(new), n))
        self.often = sizes[self.group] >= TIMES
        self.n = n
        self.keys = groups * (n + 1) + order

    def within(self, places: np.ndarray, least: int, most: int) -> np.ndarray:
        """Whether the word at each place comes again `least` to `most` places on."""
        base = self.group[places] * (self.n + 1) + places
        at = np.searchsorted(self.keys, base + least)
        found = at < self.n
        found[found] = self.keys[at[found]] <= base[found] + most
        return found


def _extend(words: np.ndarray, start: int, distance: int) -> tuple[int, int]:
    """The first and the past-the-last place of the stretch around `start` in which
    words `distance` apart are the same."""
    n = len(words)
    end, step = start, 2 * distance
    while end + distance < n:
        to = min(end + step, n - distance)
        differs = words[end:to] != words[end + distance : to + distance]
        if differs.any():
            end += int(differs.argmax())
            break
        end, step = to, 2 * step
    first, step = start, 2 * distance
    while first:
        to = max(first - step, 0)
        differs = (words[to:first] != words[to + distance : first + distance])[::-1]
        if differs.any():
            first -= int(differs.argmax())
            break
        first, step = to, 2 * step
    return first, end + distance


class _Known:
    """Runs found so far, by start, with the furthest end of those before."""

    def __init__(self) -> None:
        self.runs = np.empty((0, 3), np.int64)  # start, past the last, period
        self.furthest = np.empty(0, np.int64)

    def add(self, runs: list[tuple[int, int, int]]) -> None:
        if runs:
            self.runs = np.concatenate([self.runs, np.array(runs, np.int64)])
            self.runs = self.runs[np.argsort(self.runs[:, 0], kind="stable")]
            self.furthest = np.maximum.accumulate(self.runs[:, 1])

    def reach(self, places: np.ndarray) -> np.ndarray:
        """The furthest end of the runs that start at or before each place; -1: none."""
        at = np.searchsorted(self.runs[:, 0], places, side="right") - 1
        return np.where(at >= 0, self.furthest[np.maximum(at, 0)] if len(self.furthest) else -1, -1)


def all_runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, past the last, period) of every run within one of the texts, by
    start, then period. `words`: numbers from 0; text i ends before `ends[i]`,
    where its last place holds a number that occurs nowhere else."""
    known = _Known()
    if not len(words):
        return known.runs
    texts = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    again = _Returns(words, texts)
    longest = int(np.diff(ends, prepend=0).max()) - 1
    numbers = words.astype(np.uint64)
    block = 1
    while 4 * block <= longest:
        starts = _possible(words, again, block)
        reach = known.reach(starts)
        # Within a run that reaches so far, copies up to there are its own.
        inside = reach >= starts + block
        least = np.where(inside, np.maximum(reach - starts - block + 1, block), block)
        starts, least = starts[least < 2 * block], least[least < 2 * block]
        at, distance = mismatch_free(numbers, starts, block)
        leads_out = distance >= least[np.searchsorted(starts, at)]
        known.add(_grown(words, at[leads_out], distance[leads_out], known))
        block *= 2
    order = np.lexsort((known.runs[:, 2], known.runs[:, 0]))
    return known.runs[order]


def _possible(words: np.ndarray, again: _Returns, block: int) -> np.ndarray:
    """Starts of the blocks of which every word comes again within the window."""
    blocks = len(words) // block
    if block <= SHIFTS:
        back = np.zeros(len(words), bool)
        for d in range(block, min(2 * block, len(words))):
            back[:-d] |= words[:-d] == words[d:]
        back &= again.often
        return np.flatnonzero(back[: blocks * block].reshape(blocks, block).all(axis=1)) * block
    starts = np.flatnonzero(again.often[: blocks * block].reshape(blocks, block).all(axis=1)) * block
    for part in (slice(0, 1), slice(1, block)):  # the first word alone rules out most
        places = starts[:, None] + np.arange(block)[part]
        back = again.within(places.ravel(), block, 2 * block - 1).reshape(places.shape)
        starts = starts[back.all(axis=1)]
    return starts


def _grown(
    words: np.ndarray, at: np.ndarray, distance: np.ndarray, known: _Known
) -> list[tuple[int, int, int]]:
    """The runs that the seeds belong to and that are not known yet."""
    keep = at + 3 * distance < len(words)
    at, distance = at[keep], distance[keep]
    # From the run's first whole block, words are the same at `distance` for two
    # periods on: some are compared for all seeds at once, then all seed by seed.
    for share in (2, 1, 0):
        same = words[at + share * distance] == words[at + (share + 1) * distance]
        at, distance = at[same], distance[same]
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    found: list[tuple[int, int, int]] = []
    i = 0
    while i < len(at):
        s, d = int(at[i]), int(distance[i])
        if not np.array_equal(words[s : s + 2 * d + 1], words[s + d : s + 3 * d + 1]):
            i += 1
            continue
        first, end = _extend(words, s, d)
        if end - first >= max(LEAST, TIMES * d) and known.reach(np.array([first]))[0] < end:
            found.append((first, end, d))
        # Further seeds of this distance within the stretch say the same.
        last = int(np.searchsorted(distance, d, side="right"))
        i += max(1, int(np.searchsorted(at[i:last], end - d)))
    return found


@dataclass
class _Words:
    """The words of several texts, each with a blank behind it, one after another."""

    data: np.ndarray
    starts: np.ndarray  # of each word in `data`, and the end
    texts: np.ndarray  # the first word of each text, and the number of all


def _split(texts: list[bytes]) -> _Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    behind = blank.copy()  # the blank that ends a word
    behind[0] = False
    behind[1:] &= ~blank[:-1]
    kept = np.where(behind, np.uint8(0x20), data)[~blank | behind]
    ends = np.flatnonzero(behind)
    starts = np.concatenate(([0], np.flatnonzero(kept == 0x20) + 1))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return _Words(kept, starts, np.concatenate(([0], np.searchsorted(ends, text_ends))))


def _numbers(words: _Words) -> tuple[np.ndarray, int]:
    """A number for each word, the same for the same word, and how many there are."""
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts) - 1, [None, pa.py_buffer(words.starts), pa.py_buffer(words.data)]
    ).dictionary_encode()
    return array.indices.to_numpy().astype(np.int64), len(array.dictionary)


def _rows(doc_ids: list, texts: list[bytes]) -> pa.RecordBatch:
    words = _split(texts)
    codes, kinds = _numbers(words)
    counts = np.diff(words.texts)
    # A number of its own behind each text, so that no run goes on into the next.
    spread = np.full(len(codes) + len(texts), -1, np.int64)
    place = np.arange(len(codes)) + np.repeat(np.arange(len(texts)), counts)
    spread[place] = codes
    marks = words.texts[1:] + np.arange(len(texts))
    spread[marks] = kinds + np.arange(len(texts))
    runs = all_runs(spread, marks + 1)
    text_of = np.searchsorted(marks, runs[:, 0], side="right")
    change = np.zeros(len(spread) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    stays = (np.cumsum(change[:-1]) == 0)[place]
    lengths = np.diff(words.starts)
    data = words.data if stays.all() else words.data[np.repeat(stays, lengths)]
    ends = np.concatenate(([0], np.cumsum(lengths * stays)))[words.texts]
    joined = [data[a : max(a, b - 1)].tobytes() for a, b in zip(ends[:-1], ends[1:])]
    first = words.texts[text_of] + text_of
    values = pa.StructArray.from_arrays(
        [pa.array(c) for c in (runs[:, 0] - first, runs[:, 1] - runs[:, 0], runs[:, 2])], fields=list(_RUN)
    )
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), values),
            pa.array(joined, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, runs (start, length and
    period in words, by start, then period) and `collapsed`, the text's words with
    one blank between them, without those that a run holds after its first period.

    Words are parted by blanks, tabs, newlines, vertical tabs, form feeds and
    carriage returns. Null and empty texts have no words, no runs and an empty
    collapsed text. A null doc_id stays null; repeated rows are handled each for
    itself; other columns are left out; an empty table gives an empty result.
    Texts are taken whole, several MB of them at a time, or one longer text.
    Nothing is shuffled.
    """
    ship_package(docs.sparkSession)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                past = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, past + STRETCH, side="right")))
                part = batch.slice(at, to - at)
                yield _rows(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist())
                at = to

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(find, RUNS_SCHEMA)
