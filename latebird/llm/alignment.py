"""Alignment of two tokenizers over the same texts, by diagonal run skipping.

Each tokenizer cuts a text's bytes into tokens; the byte offsets at which tokens
end are two rising arrays, and offsets in both cut the tokens into groups. Over
long stretches both tokenizers agree, word for word, so that the groups are one
to one and the arrays equal at a fixed shift of index. From each common end the
arrays are compared at that shift in steps of 1, 2, 4, ... entries; where a step
fails, halved steps find the last equal entry. The tokens behind it are an
irregular group, resolved by moving on in whichever array is behind; the shift
is then that of the group's end.

Every pair of tokens of a group is a link. The count of a pair of ids is the
number of documents that hold it linked. Documents go through the tokenizers
once; their distinct pairs are written to the shared folder in blocks of
documents. Pairs are counted from there, with partial counts before the shuffle,
and the counts go back by (block, pair): a block's pairs are far fewer than its
documents' pairs, and no key is in more rows than there are blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, staged, text_or_empty
from latebird.llm.tokenizing import BLANK, SentencePieces, WordTokenizer

#: Bytes of text handled at once, at least one text.
STRETCH = 2 << 20
#: Pieces that each of a task's two tokenizers remembers.
REMEMBERED = 300_000
#: Distinct pairs of a block's documents, at least one document.
BLOCK = 1 << 21
#: Block numbers of one task; the task's number stands above these bits.
TASK_BITS = 40
#: Links of a group up to which they are written out singly, and links at a time.
SINGLY = 64
LINKS = 1 << 20
#: A pair of ids as one number: the first above these bits.
ID_BITS = 20

ALIGNED_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "block long, pairs array<long>, times array<long>"
)
SCORED_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: visible
    Latin-1 signs for themselves, the other bytes for those from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(others)}


def word_bytes(tokenizer: WordTokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    signs = _byte_signs()
    entries = sorted((i, entry) for entry, i in tokenizer.parted.get_vocab().items())
    return [bytes(signs[c] for c in entry) for _, entry in entries]


def piece_bytes(tokenizer: SentencePieces) -> list[bytes]:
    """The bytes of each id of a piece model: one byte for `<0xHH>`, else the
    piece in UTF-8 with blanks."""
    model = tokenizer.model
    return [
        bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode()
        for i, piece in enumerate(tokenizer.all_pieces())
    ]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices in both rising arrays of the values that stand in both. The
    last values must be equal."""
    a, b = ends_a.tolist(), ends_b.tolist()
    n = len(a)
    at_a, at_b, lengths = [], [], []
    i = j = 0
    while i < n:
        x, y = a[i], b[j]
        while x != y:  # an irregular group: up to the next common end
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        # A common end. How many more follow at the shift j - i?
        p, q, step = i + 1, j + 1, 1
        while p < n and a[p : p + step] == b[q : q + step]:
            p, q, step = p + step, q + step, 2 * step
        p = min(p, n)
        q = p + j - i
        while step > 1:
            step //= 2
            if p < n and a[p : p + step] == b[q : q + step]:
                p, q = min(p + step, n), min(p + step, n) + j - i
        at_a.append(i)
        at_b.append(j)
        lengths.append(p - i)
        i, j = p, q
    lengths = np.array(lengths, np.int64)
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(at_a, lengths) + within, np.repeat(at_b, lengths) + within


@dataclass
class _Side:
    """The tokens of several texts by one tokenizer."""

    ids: np.ndarray
    starts: np.ndarray  # of each text's tokens, and the end
    ends: np.ndarray  # byte offset of each token's end
    data: np.ndarray  # all tokens' bytes


class Aligner:
    """Aligns texts under a byte-level tokenizer file and a piece model."""

    def __init__(self, name_a: str, name_b: str, remembered: int = REMEMBERED):
        self.a = WordTokenizer(name_a, remembered, special_text=True)
        self.b = SentencePieces(name_b, remembered)
        tables = word_bytes(self.a), piece_bytes(self.b)
        self.bytes_a, self.bytes_b = (pa.array(t, pa.large_binary()) for t in tables)
        # What follows an id in the written form of groups: the next id of its
        # side, or the other side, or the next group.
        sizes = [len(t) for t in tables]
        forms = [f"{i}{sign}".encode() for n, signs in zip(sizes, (",|", ",;")) for sign in signs for i in range(n)]
        self.forms = pa.array(forms, pa.large_binary())
        self.n_a, self.n_b = sizes

    def _side(self, tokenizer, table: pa.Array, texts: list[bytes]) -> _Side:
        ids, starts = tokenizer.encode(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        _, offsets, data = table.take(pa.array(ids)).buffers()
        ends = np.frombuffer(offsets, np.int64)[1 : len(ids) + 1]
        return _Side(ids.astype(np.int64), starts, ends, np.frombuffer(data, np.uint8))

    def whole(self, texts: list[bytes]) -> tuple[list[bytes], _Side, _Side, np.ndarray]:
        """The texts, those emptied whose tokens don't give their bytes, both
        sides of them, and which are left."""
        left = np.array([bool(t) and BLANK.encode() not in t for t in texts])
        while True:
            kept = [b" " + t for t, good in zip(texts, left) if good]
            if not kept:
                none = np.empty(0, np.int64)
                empty = _Side(none, np.zeros(1, np.int64), none, none)
                return [], empty, empty, left
            sides = self._side(self.a, self.bytes_a, kept), self._side(self.b, self.bytes_b, kept)
            wanted = np.frombuffer(b"".join(kept), np.uint8)
            if all(np.array_equal(s.data[: s.ends[-1]], wanted) for s in sides):
                return kept, *sides, left
            places = np.flatnonzero(left)
            for place, text, *spans in zip(places, kept, *(zip(s.starts[:-1], s.starts[1:]) for s in sides)):
                for side, table, (first, end) in zip(sides, (self.bytes_a, self.bytes_b), spans):
                    own = b"".join(table.take(pa.array(side.ids[first:end])).to_pylist())
                    left[place] &= own == text

    def align(self, texts: list[bytes], written: str | None) -> dict[str, list]:
        """For each text: its numbers of tokens, groups and links, the groups in
        written form, and its distinct pairs with how often each is linked."""
        kept, a, b, left = self.whole(texts)
        none = np.empty(0, np.int64)
        out: dict[str, list] = {k: [0] * len(texts) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out["groups"] = [None if written is None else ""] * len(texts)
        out |= {"pairs": [none] * len(texts), "times": [none] * len(texts)}
        if not kept:
            return out
        end_a, end_b = common_ends(a.ends, b.ends)
        groups = _Groups(end_a, end_b, np.searchsorted(end_a, a.starts))
        keys, times = groups.pairs(a.ids, b.ids)
        first_pair = np.searchsorted(keys, np.arange(len(kept) + 1) << 2 * ID_BITS)
        pairs = keys & ((1 << 2 * ID_BITS) - 1)
        link_ends = np.concatenate(([0], np.cumsum(groups.links)))
        if written:
            data, offsets = self._written(a.ids, b.ids, groups)
        for k, place in enumerate(np.flatnonzero(left)):
            first, end = groups.bounds[k : k + 2]
            out["n_a"][place] = int(a.starts[k + 1] - a.starts[k])
            out["n_b"][place] = int(b.starts[k + 1] - b.starts[k])
            out["n_groups"][place] = int(end - first)
            out["n_links"][place] = int(link_ends[end] - link_ends[first])
            out["pairs"][place] = pairs[first_pair[k] : first_pair[k + 1]]
            out["times"][place] = times[first_pair[k] : first_pair[k + 1]]
            if written:
                tokens = a.starts[k : k + 2] + b.starts[k : k + 2]
                text = data[offsets[tokens[0]] : offsets[tokens[1]] - 1]  # without the last sign
                out["groups"][place] = (
                    hashlib.sha256(text).hexdigest() if written == "sha256" else text.tobytes().decode()
                )
        return out

    def _written(self, ids_a: np.ndarray, ids_b: np.ndarray, groups: _Groups) -> tuple[np.ndarray, np.ndarray]:
        """All groups as `a1,a2|b1;a3|b2,b3;`, and where each id begins there."""
        number = np.arange(len(groups.links))
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[groups.end_a] = last_b[groups.end_b] = True
        forms = np.empty(len(ids_a) + len(ids_b), np.int64)
        b_before = groups.end_b - groups.size_b + 1
        a_before = groups.end_a + 1
        forms[np.arange(len(ids_a)) + b_before[np.repeat(number, groups.size_a)]] = ids_a + last_a * self.n_a
        forms[np.arange(len(ids_b)) + a_before[np.repeat(number, groups.size_b)]] = (
            ids_b + last_b * self.n_b + 2 * self.n_a
        )
        _, offsets, data = self.forms.take(pa.array(forms)).buffers()
        return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)


class _Groups:
    """Groups of tokens: the last token of each on both sides, and which text has
    groups `bounds[i]` to `bounds[i + 1]`."""

    def __init__(self, end_a: np.ndarray, end_b: np.ndarray, bounds: np.ndarray):
        self.end_a, self.end_b, self.bounds = end_a, end_b, bounds
        self.size_a, self.size_b = np.diff(end_a, prepend=-1), np.diff(end_b, prepend=-1)
        self.links = self.size_a * self.size_b

    def pairs(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (text, pair) as numbers, rising, and how often each is linked."""
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds)) << 2 * ID_BITS
        few = np.flatnonzero(self.links <= SINGLY)
        cuts = np.searchsorted(np.cumsum(self.links[few]), np.arange(0, self.links[few].sum(), LINKS)[1:])
        parts = []
        for own in np.split(few, cuts):
            links, wide = self.links[own], self.size_b[own]
            group = np.repeat(np.arange(len(own)), links)
            within = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
            a = (self.end_a - self.size_a + 1)[own][group] + within // wide[group]
            b = (self.end_b - self.size_b + 1)[own][group] + within % wide[group]
            keys = text[own][group] | ids_a[a] << ID_BITS | ids_b[b]
            parts.append(_summed(keys, np.ones(len(keys), np.int64)))
        for g in np.flatnonzero(self.links > SINGLY):  # by distinct ids of both sides
            a, n_a = np.unique(ids_a[self.end_a[g] - self.size_a[g] + 1 : self.end_a[g] + 1], return_counts=True)
            b, n_b = np.unique(ids_b[self.end_b[g] - self.size_b[g] + 1 : self.end_b[g] + 1], return_counts=True)
            keys = text[g] | a[:, None] << ID_BITS | b
            parts.append((keys.ravel(), (n_a[:, None] * n_b).ravel()))
        return _summed(*(np.concatenate(p) for p in zip(*parts)))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, rising, with the sums of their times."""
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(name_a: str, name_b: str) -> Aligner:
    """One pair of tokenizers for each worker process."""
    if (name_a, name_b) not in _aligners:
        _aligners[name_a, name_b] = Aligner(name_a, name_b)
    return _aligners[name_a, name_b]


def align_documents(
    docs: DataFrame,
    tokenizer_a: str = "byte_bpe_50k.json",
    tokenizer_b: str = "piece_bpe_32k.model",
    written: str | None = "text",
) -> DataFrame:
    """Align each text of `docs` (doc_id, text) under a byte-level tokenizer file
    (A) and a piece model (B), with a blank in front of the text.

    Per row: doc_id, n_a, n_b (tokens), n_groups, n_links, `groups` in the form
    `a1,a2|b1;a3|b2,b3` (`written="sha256"`: the digest of that text, where there
    is one; None: null), and for `pair_counts` and `score_links` the distinct
    pairs, how often each is linked, and a number of the block of documents.

    Texts that are null, empty, or not the bytes of their tokens (such as those
    with U+2581, which B writes as a blank) have no tokens: zeros, and an empty
    text for groups. Special tokens' strings are ordinary text. A null doc_id
    stays null; repeated rows are handled each for itself; other columns are left
    out; an empty table gives an empty result. Texts are taken whole, about 2 MB
    of them at a time, or one longer text.
    """
    if written not in (None, "text", "sha256"):
        raise ValueError(f"no written form {written!r}")
    ship_package(docs.sparkSession)

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(tokenizer_a, tokenizer_b)
        block, held = TaskContext.get().partitionId() << TASK_BITS, 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                past = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, past + STRETCH, side="right")))
                part = batch.slice(at, to - at)
                found = aligner.align(part.column(1).cast(pa.large_binary()).to_pylist(), written)
                blocks = []
                for pairs in found["pairs"]:
                    if held and held + len(pairs) > BLOCK:
                        block, held = block + 1, 0
                    held += len(pairs)
                    blocks.append(block)
                yield _aligned_batch(part.column(0), found, blocks)
                at = to

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(align, ALIGNED_SCHEMA)


def _aligned_batch(doc_ids: pa.Array, found: dict[str, list], blocks: list[int]) -> pa.RecordBatch:
    offsets = pa.array(np.cumsum([0, *map(len, found["pairs"])]), pa.int32())
    lists = {
        k: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found[k]))) for k in ("pairs", "times")
    }
    numbers = {k: pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")}
    groups = pa.array(found["groups"], pa.string())
    columns = {"doc_id": doc_ids, **numbers, "groups": groups, "block": pa.array(blocks, pa.int64()), **lists}
    return pa.RecordBatch.from_pydict(columns)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, documents, best) of each linked pair of ids: in how many documents it
    is linked, and whether no pair of the same `a` is in more."""
    counts = (
        aligned.select(F.explode("pairs").alias("pair"))
        .groupBy("pair")
        .agg(F.count("*").alias("documents"))
        .select(
            F.shiftright("pair", ID_BITS).alias("a"),
            F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("b"),
            "documents",
        )
    )
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document of `aligned` (a stored table): n_best, the links whose pair is
    its A id's most frequent one, and count_sum, the sum of all links' counts."""
    numbered = counts.select(
        (F.shiftleft("a", ID_BITS) + F.col("b")).alias("pair"), "documents", F.col("best").cast("long").alias("best")
    )
    wanted = aligned.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).distinct()
    known = wanted.join(numbered, "pair").groupBy("of_block")

    def score(documents: pa.Table, counted: pa.Table) -> pa.Table:
        pair = counted.column("pair").to_numpy()
        order = np.argsort(pair)
        numbers, best = (counted.column(c).to_numpy()[order] for c in ("documents", "best"))
        documents = documents.combine_chunks()
        lists = documents.column("pairs").combine_chunks()
        at = np.searchsorted(pair[order], pc.list_flatten(lists).to_numpy())
        times = pc.list_flatten(documents.column("times").combine_chunks()).to_numpy()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)

        def sums(values: np.ndarray) -> pa.Array:
            totals = np.concatenate(([0], np.cumsum(values[at] * times)))[np.concatenate(([0], ends))]
            return pa.array(np.diff(totals), pa.int64())

        return pa.table(
            {
                **{c: documents.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                "n_best": sums(best),
                "count_sum": sums(numbers),
                "groups": documents.column("groups"),
            }
        )

    return aligned.groupBy("block").cogroup(known).applyInArrow(score, SCORED_SCHEMA)


def align_tokenizers(
    docs: DataFrame,
    tokenizer_a: str = "byte_bpe_50k.json",
    tokenizer_b: str = "piece_bpe_32k.model",
    written: str | None = "text",
) -> DataFrame:
    """`align_documents`, stored, with the corpus-wide counts of its links: doc_id,
    n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    aligned = staged(align_documents(docs, tokenizer_a, tokenizer_b, written), "aligned")
    return score_links(aligned, staged(pair_counts(aligned), "pair-counts"))
