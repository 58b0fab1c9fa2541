"""Tokenizing, token files (9) and packing (6) against the tokenizer and round trips."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from latebird.llm import catalog, tokenfiles
from latebird.llm.packing import Limits, Packer, Piece, first_line, pack_documents
from latebird.llm.tokenfiles import (
    TokenFile,
    TokenFileWriter,
    bits_for,
    pack_bits,
    read_token_files,
    unpack_bits,
    write_token_files,
)
from latebird.llm.tokenizing import SentencePieces, WordTokenizer

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
SIGNS = [*" \n\t ab'sTéÉß12.,#<|>Σς́–ſ　\x85\x1c", "<|endoftext|>", "<|startoftext|>", " the", "'s", "\n\n"]


def plain(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def whole(name, texts, end):
    encoded = plain(name).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, end], "<u4") for e in encoded]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("special_text", [False, True])
def test_pieces_give_the_ids_of_whole_texts(name, special_text):
    ours, theirs = WordTokenizer(name, remembered=50, stretch=40, special_text=special_text), plain(name)
    if special_text:
        theirs.encode_special_tokens = True

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join), max_size=5))
    def check(texts):
        got = list(ours.rows(pa.array(texts, pa.string())))
        for ids, text in zip(got, texts, strict=True):
            assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids

    check()


def test_sentence_pieces_give_the_ids_of_whole_texts():
    name = "piece_bpe_32k.model"
    ours = SentencePieces(name, remembered=50, stretch=40)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(SIGNS + ["<s>", "  ", "\0"]), max_size=30).map("".join), max_size=5))
    def check(texts):
        got = list(ours.rows(pa.array([" " + t for t in texts], pa.string())))
        for ids, text in zip(got, texts, strict=True):
            assert ids.tolist() == (ours.model.encode(text) or [ours.blank])

    check()


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bits_round_trip(width, data):
    ids = data.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=70))
    packed = pack_bits(np.array(ids, "<u4"), width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert unpack_bits(packed, width, len(ids)).tolist() == ids


def test_bits_for_vocabulary():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 49_408, 50_257)] == [1, 1, 2, 8, 9, 16, 16]
    with pytest.raises(ValueError):
        pack_bits(np.array([8], "<u4"), 3)


@pytest.mark.parametrize("width", [11, 16])
def test_file_random_access(tmp_path, width):
    rng = np.random.default_rng(1)
    documents = [rng.integers(0, 1 << width, n).astype("<u4") for n in (0, 5, 100, 1, 0, 33)]
    writer = TokenFileWriter(str(tmp_path / "ids.bin"), width, block_ids=16)
    for i, ids in enumerate(documents):
        writer.add(None if i == 3 else i, ids)
    assert writer.close()[:2] == (6, 139)
    file = TokenFile(str(tmp_path / "ids.bin"))
    everything = np.concatenate(documents)
    assert np.diff(file.block_offsets).tolist() == [2 * width] * 8 + [-(-11 * width // 8)]
    for a, b in ((0, 139), (15, 17), (16, 32), (138, 139), (7, 7)):
        assert file.read_ids(a, b).tolist() == everything[a:b].tolist()
    got = list(file.documents(span=20))
    assert [g[0] for g in got] == [0, 1, 2, None, 4, 5]
    assert all(np.array_equal(g[2], d) for g, d in zip(got, documents))


def test_token_files_query(spark, small_dir, rows):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op9_token_files"](spark, small_dir).collect()}
    start = 0
    ordered = sorted(rows)
    for (doc_id, *_), ids in zip(ordered, whole(NAMES[1], [r[1] for r in ordered], 2), strict=True):
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_edges(spark, edge_docs, no_docs, tmp_path):
    manifest = write_token_files(edge_docs, str(tmp_path / "a"))
    got = read_token_files(spark, manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 3, 3, 4, 5, 6, 7]
    assert sum(r["n_tokens"] for r in got) == manifest.agg({"n_ids": "sum"}).first()[0]
    assert [r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 6)] == [1, 1, 1]
    assert read_token_files(spark, write_token_files(no_docs, str(tmp_path / "b"))).count() == 0


def check_pieces(pieces, expected, limits):
    """All ids once, offsets gapless, limits kept; lengths of the sequences."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert by_doc.keys() == expected.keys()
    for doc_id, ids in expected.items():
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert np.frombuffer(p["ids"], "<u4").tolist() == ids[at : at + p["length"]].tolist()
            at += p["length"]
        assert at == len(ids)
    lengths = []
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(members) <= limits.segments
        assert sum(p["loss_tokens"] for p in members) <= limits.loss_tokens
        lengths.append(at)
    return lengths


def test_packing_query(spark, small_dir, rows):
    expected = dict(zip([r[0] for r in rows], whole(NAMES[0], [r[1] for r in rows], 1)))
    got = catalog.QUERIES["op6_vector_packing"](spark, small_dir).collect()
    at = {}
    for p in sorted(got, key=lambda p: (p["doc_id"], p["start"])):
        ids = expected[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["start"] == at.get(p["doc_id"], 0) and p["doc_tokens"] == len(expected[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(ids.tobytes())
        at[p["doc_id"]] = p["start"] + p["length"]
    assert at == {k: len(v) for k, v in expected.items()}
    prompts = [(r[1] or "").partition("\n") for r in rows]
    prompts = [line.rstrip(" \t\r\v\f") if end else "" for line, end, _ in prompts]
    before = dict(zip([r[0] for r in rows], [len(x) - 1 for x in whole(NAMES[0], prompts, 1)]))
    in_sequence = {}
    for p in got:
        n = p["start"] + p["length"] - max(p["start"], before[p["doc_id"]])
        assert p["loss_tokens"] == max(0, n)
        tokens, loss = in_sequence.get(p["sequence_id"], (0, 0))
        in_sequence[p["sequence_id"]] = (tokens + p["length"], loss + p["loss_tokens"])
    assert max(loss for _, loss in in_sequence.values()) == 1920  # the limit binds
    assert all(n == 2048 or n & (n - 1) == 0 for n, _ in in_sequence.values())
    full = sum(n for n, _ in in_sequence.values() if n == 2048)
    assert full > 0.8 * sum(n for n, _ in in_sequence.values())


def test_packing_has_no_padding(spark, documents, rows):
    limits = Limits(tokens=2048)
    expected = dict(zip([r[0] for r in rows], whole(NAMES[0], [r[1] for r in rows], 1)))
    lengths = check_pieces(pack_documents(documents, limits).collect(), expected, limits)
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)


def test_packing_under_three_limits(spark, documents, rows):
    limits = Limits(tokens=256, segments=3, loss_tokens=100)
    expected = dict(zip([r[0] for r in rows], whole(NAMES[0], [r[1] for r in rows], 1)))
    packed = pack_documents(documents, limits, loss_from=F.col("doc_id") % 400).collect()
    lengths = check_pieces(packed, expected, limits)
    assert all(n == 256 or n & (n - 1) == 0 for n in lengths)


def test_packing_by_prompts(spark):
    texts = ["ask \nanswer\nmore", "no line", None, "\nblank line first", "x" * 50 + "\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = pack_documents(frame, Limits(tokens=64, loss_tokens=8), prompt=first_line()).collect()
    got = {}
    for p in packed:
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"] - p["loss_tokens"]
    prompts = ["ask", "", "", "", "x" * 50]
    assert got == {i: len(ids) - 1 for i, ids in enumerate(whole(NAMES[0], prompts, 1))}
    with pytest.raises(ValueError, match="not both"):
        pack_documents(frame, loss_from=F.lit(1), prompt=first_line())


def test_packing_edges(edge_docs, no_docs):
    counts = {}
    for p in pack_documents(edge_docs).collect():
        counts[p["doc_id"]] = counts.get(p["doc_id"], 0) + p["length"]
    assert counts[1] == counts[2] == 1 and counts[5] > 100_000
    assert counts[3] > 0 and counts[None] > 1
    assert pack_documents(no_docs).count() == 0


def test_dot_product_prefers_what_the_bin_lacks():
    packer = Packer(Limits(tokens=10, segments=4, loss_tokens=5), pool=8, stay=0)

    def piece(doc, tokens, loss_from):
        return Piece(doc, 0, memoryview(bytes(4 * tokens)), tokens, loss_from)

    for p in (piece(1, 5, 0), piece(2, 4, 4), piece(3, 4, 0), piece(4, 1, 1)):
        assert list(packer.add(p)) == []
    first = next(packer.finish())
    # The loss-bearing example fills the loss limit; the prompts fill the rest.
    assert sorted(p.doc_id for p in first) == [1, 2, 4]


def test_manifest_lists_one_attempt(spark, documents, tmp_path):
    manifest = write_token_files(documents, str(tmp_path / "c"))
    stray = str(tmp_path / "c" / "ids-000000-stray.bin")
    TokenFileWriter(stray, 16).close()  # as a lost attempt leaves it
    assert stray not in [r["path"] for r in manifest.collect()]
    assert read_token_files(spark, manifest).count() == documents.count()
    assert tokenfiles.BLOCK_IDS % 8 == 0


def test_second_vocabulary_is_loaded_for_special_strings_only():
    """Two copies of a vocabulary a worker took memory that most never use."""
    own = WordTokenizer("byte_bpe_50k.json")
    ids, _ = own.encode(pa.array(["plain words only", "and more of them"]))
    assert len(ids) and "plain" not in vars(own)
    text = f"before {own.mark} after"
    ids, _ = own.encode(pa.array([text]))
    assert "plain" in vars(own)
    assert ids.tolist() == own.plain.encode(text, add_special_tokens=False).ids
