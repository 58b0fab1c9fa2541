"""Token ids from a public tokenizer, with the ids of recurring words remembered.

Under the vocabularies in use a word, with the white space in front of it, is
encoded the same wherever it stands. A column of texts is cut where a plain
letter or sign is followed by a blank or a newline, which is such a place under
the rules of the `tokenizers` files; Arrow finds the distinct pieces, each of
which is given to the tokenizer once, and numpy gathers the ids. Many pieces go
to the tokenizer in one string, parted by a special token, which the tokenizer
cuts out before it looks at anything else. A `sentencepiece` model is cut before
blanks, which none of its pieces has behind another sign.
`tests/llm/test_tokens.py` compares with the tokenizers on whole texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

# Spark's tasks are the parallelism; threads within each would only add memory.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of text handled at once, at least one piece; texts are cut on the way.
STRETCH = 6 << 20
#: Pieces remembered, and their bytes, before the memory starts anew.
REMEMBERED = 800_000
REMEMBERED_BYTES = 64 << 20
#: How a `sentencepiece` model writes a blank.
BLANK = "\u2581"
#: Pieces handed to the tokenizer in one string.
TOGETHER = 200
#: Such strings encoded at a time.
STRINGS = 32


def _places(data: np.ndarray) -> np.ndarray:
    """Where a piece may begin: at a blank or newline after an ASCII sign or a
    letter of two bytes from U+00C0 to U+017F."""
    blank = (data == 0x20) | (data == 0x0A)
    at = np.flatnonzero(blank[1:]) + 1
    before = data[at - 1]
    ascii_sign = (before > 0x20) & (before < 0x7F)
    lead = data[np.maximum(at - 2, 0)]
    latin = (before >= 0x80) & (lead >= 0xC3) & (lead <= 0xC5)
    return at[ascii_sign | latin]


class PieceMemory:
    """Encodes columns of texts; keeps the ids of the pieces it has met."""

    def __init__(self, remembered: int = REMEMBERED, stretch: int = STRETCH):
        self.remembered, self.stretch = remembered, stretch
        self._forget()

    @staticmethod
    def places(data: np.ndarray) -> np.ndarray:
        """Where in the bytes of texts a piece may begin."""
        raise NotImplementedError

    def _encode_fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has."""
        raise NotImplementedError

    def _forget(self) -> None:
        self._known = pa.array([], pa.large_string())  # their places are those of the next two
        self._starts = np.zeros(1 << 12, np.int64)
        self._lengths = np.zeros(1 << 12, np.int64)
        self._ids = np.zeros(1 << 14, "<u4")
        self._used = self._bytes = 0

    def rows(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each of `texts`, encoded in groups of about `stretch` bytes."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            past = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, past + self.stretch, side="right")))
            ids, starts = self.encode(texts.slice(at, to - at))
            for a, b in zip(starts[:-1], starts[1:]):
                yield ids[a:b]
            at = to

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `texts` (without nulls) as little-endian unsigned
        32-bit numbers, and where each text's ids begin, and the last end."""
        texts = texts.cast(pa.large_string())
        _, offset_buffer, data_buffer = texts.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if data_buffer is None or offsets[0] == offsets[-1]:
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        base, end = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(data_buffer, np.uint8)[base:end]
        offsets = offsets - base
        begins = np.zeros(len(data), bool)
        begins[self.places(data)] = True
        begins[offsets[offsets < len(data)]] = True
        starts = np.flatnonzero(begins)
        first_piece = np.searchsorted(starts, offsets)
        bounds = np.append(starts, len(data))
        parts, counts = [], []
        at = 0
        while at < len(starts):
            to = int(np.searchsorted(bounds, bounds[at] + self.stretch, side="right")) - 1
            to = max(to, at + 1)
            ids, lengths = self._encode_pieces(data, bounds[at : to + 1])
            parts.append(ids)
            counts.append(lengths)
            at = to
        ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
        return (parts[0] if len(parts) == 1 else np.concatenate(parts)), ends[first_piece]

    def _encode_pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pieces = pa.LargeStringArray.from_buffers(
            len(bounds) - 1,
            pa.py_buffer(np.ascontiguousarray(bounds - bounds[0])),
            pa.py_buffer(data[bounds[0] : bounds[-1]]),
        ).dictionary_encode()
        number = self._numbers(pieces.dictionary)[pieces.indices.to_numpy()]
        lengths = self._lengths[number]
        ends = np.cumsum(lengths)
        places = np.repeat(self._starts[number] - ends + lengths, lengths)
        places += np.arange(len(places))
        return self._ids[places], lengths

    def _numbers(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """The place of each of the distinct `pieces` among the known ones."""
        if len(self._known) > self.remembered or self._bytes > REMEMBERED_BYTES:
            self._forget()
        number = pc.index_in(pieces, value_set=self._known).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            fresh = pieces.take(pa.array(missing))
            ids, lengths = self._encode_fresh(fresh.to_pylist())
            n, to = len(self._known), len(self._known) + len(fresh)
            self._known = pa.concat_arrays([self._known, fresh])
            self._starts = _room(self._starts, to)
            self._lengths = _room(self._lengths, to)
            self._ids = _room(self._ids, self._used + len(ids))
            self._starts[n:to] = self._used + np.cumsum(lengths) - lengths
            self._lengths[n:to] = lengths
            self._ids[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
            self._bytes += pc.sum(pc.binary_length(fresh)).as_py()
            number[missing] = np.arange(n, to)
        return number


class WordTokenizer(PieceMemory):
    """A tokenizer file of the `tokenizers` library.

    `name`: one of the installed public tokenizers, or the path of a tokenizer
    file, on every worker, whose rules part words before white space. Strings of
    special tokens in a text become their ids, as in a plain call of the
    tokenizer, or with `special_text` are ordinary text.
    """

    places = staticmethod(_places)

    def __init__(
        self,
        name: str,
        remembered: int = REMEMBERED,
        stretch: int = STRETCH,
        special_text: bool = False,
    ):
        self.file = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.special_text = special_text
        self.parted = self._loaded()
        self.special = [t.content for t in self.parted.get_added_tokens_decoder().values()]
        self.mark = self.special[-1]
        self.mark_id = self.parted.token_to_id(self.mark)
        super().__init__(remembered, stretch)

    def _loaded(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.file)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        return tokenizer

    @cached_property
    def plain(self):
        """The tokenizer for pieces that hold special tokens' strings; most workers
        meet none, and a vocabulary takes tens of MB."""
        tokenizer = self._loaded()
        tokenizer.encode_special_tokens = self.special_text
        return tokenizer

    def _encode_fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        together = "".join(pieces)
        if any(mark in together for mark in self.special):
            encoded = self.plain.encode_batch_fast(pieces, add_special_tokens=False)
            lengths = np.fromiter((len(e.ids) for e in encoded), np.int64, len(pieces))
            return np.fromiter(chain.from_iterable(e.ids for e in encoded), "<u4"), lengths
        parts = []
        for at in range(0, len(pieces), TOGETHER * STRINGS):  # an encoding is large: a few at a time
            strings = [
                self.mark.join(pieces[i : i + TOGETHER]) + self.mark
                for i in range(at, min(at + TOGETHER * STRINGS, len(pieces)), TOGETHER)
            ]
            encoded = self.parted.encode_batch_fast(strings, add_special_tokens=False)
            parts.append(np.fromiter(chain.from_iterable(e.ids for e in encoded), "<u4"))
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == self.mark_id)
        lengths = np.diff(ends, prepend=-1) - 1
        return np.delete(ids, ends), lengths


class SentencePieces(PieceMemory):
    """A `sentencepiece` model without normalisation, for texts with a blank in
    front, which stands for the blank that the model would put there. Texts hold
    no `BLANK` of their own."""

    def __init__(self, name: str, remembered: int = REMEMBERED, stretch: int = STRETCH):
        from sentencepiece import SentencePieceProcessor

        file = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.model = SentencePieceProcessor(model_file=file)
        if any(BLANK in piece.lstrip(BLANK) for piece in self.all_pieces()):
            raise ValueError(f"{name}: a piece has a blank behind another sign")
        self.blank = self.model.piece_to_id(BLANK)
        super().__init__(remembered, stretch)

    def all_pieces(self) -> list[str]:
        return [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]

    @staticmethod
    def places(data: np.ndarray) -> np.ndarray:
        blank = data == 0x20
        return np.flatnonzero(blank[1:] & ~blank[:-1]) + 1

    def _encode_fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The model puts a blank in front itself, but not where nothing follows.
        encoded = self.model.encode([p[1:] for p in pieces], out_type=int, num_threads=1)
        ids = [own or [self.blank] for own in encoded]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(lengths.sum())), lengths


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.zeros(max(size, len(values) * 3 // 2), values.dtype)
    grown[: len(values)] = values
    return grown


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(name: str) -> WordTokenizer:
    """One tokenizer for each vocabulary and worker process."""
    if name not in _tokenizers:
        _tokenizers[name] = WordTokenizer(name)
    return _tokenizers[name]
