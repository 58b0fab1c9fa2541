"""Two tokenizers aligned, against the tokenizers themselves and brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from latebird.llm import alignment
from latebird.llm.alignment import Aligner, align_documents, align_tokenizers, common_ends, pair_counts
from latebird.llm.catalog import QUERIES
from latebird.llm.common import staged

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = dict(zip([*map(chr, VISIBLE), *(chr(256 + i) for i in range(68))], [*VISIBLE, *sorted({*range(256)} - {*VISIBLE})]))


def tokens(text):
    """(id, bytes) of each token, for both tokenizers; none where the bytes differ."""
    if not text:
        return [], []
    encoded = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(SIGNS[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        raw = bytes.fromhex(piece[3:5]) if B.is_byte(i) else piece.replace("▁", " ").encode()
        b.append((i, raw))
    wanted = (" " + text).encode()
    if any(b"".join(t for _, t in side) != wanted for side in (a, b)):
        return [], []
    return a, b


def groups_of(text):
    a, b = tokens(text)
    found, i, j, x, y = [], 0, 0, 0, 0
    first = (0, 0)
    while i < len(a):
        if x <= y:
            x += len(a[i][1])
            i += 1
        while y < x:
            y += len(b[j][1])
            j += 1
        if x == y:
            found.append(([t[0] for t in a[first[0] : i]], [t[0] for t in b[first[1] : j]]))
            first = (i, j)
    return found


def brute(rows):
    """The contract's rows by plain loops."""
    all_groups = [groups_of(text) for _, text in rows]
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for groups in all_groups]
    counts = Counter(p for own in links for p in own)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc_id, _), groups, own in zip(rows, all_groups, links):
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append(
            (
                doc_id,
                sum(len(ga) for ga, _ in groups),
                sum(len(gb) for _, gb in groups),
                len(groups),
                sum(own.values()),
                sum(n for p, n in own.items() if counts[p] == highest[p[0]]),
                sum(n * counts[p] for p, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


ends = st.lists(st.integers(1, 60), max_size=40, unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(ends, ends, st.integers(0, 80))
def test_common_ends(a, b, run):
    tail = list(range(61, 62 + run))  # a long one-to-one stretch, and a common last end
    a, b = a + tail, b + tail
    at_a, at_b = common_ends(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert [a[i] for i in at_a] == common == [b[j] for j in at_b]


def test_query_equals_brute_force(spark, small_dir, rows):
    found = QUERIES["op12_diagonal_alignment"](spark, small_dir)
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert found.columns == names
    assert sorted(map(tuple, found.collect())) == sorted(brute([(r[0], r[1]) for r in rows]))


MIXED = [*"aaé日\n\t\0 ▁ß😀", "  ", " the", "<0x41>", "<s>", "<|endoftext|>", " Donau", "dampf", "schiff", "𝕏"]


def test_groups_of_strange_texts():
    aligner = Aligner("byte_bpe_50k.json", "piece_bpe_32k.model", remembered=50)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(MIXED), max_size=40).map("".join), max_size=5))
    def check(texts):
        found = aligner.align([t.encode() for t in texts], "text")
        for i, text in enumerate(texts):
            groups = groups_of(text)
            written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            assert found["groups"][i] == written
            own = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
            pairs = zip(found["pairs"][i].tolist(), found["times"][i].tolist())
            assert {(p >> 20, p & 0xFFFFF): n for p, n in pairs} == own
            assert found["n_links"][i] == sum(own.values())

    check()


@pytest.mark.parametrize("singly,links", [(1, 50), (64, 7)])
def test_links_of_large_groups(singly, links, monkeypatch):
    monkeypatch.setattr(alignment, "SINGLY", singly)
    monkeypatch.setattr(alignment, "LINKS", links)
    test_groups_of_strange_texts()


def test_blocks_do_not_matter(spark, documents, monkeypatch):
    rows = documents.select("doc_id", "text").limit(60)
    whole = sorted(map(tuple, align_tokenizers(rows).collect()))
    monkeypatch.setattr(alignment, "BLOCK", 300)  # pickled with the task's function
    few = staged(align_documents(rows), "aligned")
    assert sorted(map(tuple, alignment.score_links(few, pair_counts(few)).collect())) == whole


def test_edges(spark, edge_docs, no_docs):
    given = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    found = [tuple(r) for r in align_tokenizers(edge_docs, written="sha256").collect()]
    assert sorted(found, key=str) == sorted(brute(given), key=str)
    assert align_tokenizers(no_docs).collect() == []
