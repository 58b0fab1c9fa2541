"""Periodic runs against brute force."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from latebird.llm import periods
from latebird.llm.catalog import QUERIES
from latebird.llm.periods import all_runs, find_periodic_runs, mismatch_free

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words):
    """Runs as (start, length, period), by trying every period."""
    found = []
    n = len(words)
    for q in range(1, n // periods.TIMES + 1):
        x = 0
        while x + q < n:
            first = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            length = x - first + q
            if x > first and length >= max(periods.LEAST, periods.TIMES * q):
                smaller = any(f <= first and first + length <= f + m and q % p == 0 for f, m, p in found)
                if not smaller:
                    found.append((first, length, q))
            x += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def own_runs(texts):
    words, ends = [], []
    for i, text in enumerate(texts):
        words += [*text, 1000 + i]
        ends.append(len(words))
    runs = all_runs(np.array(words, np.int64), np.array(ends))
    per_text = [[] for _ in texts]
    for first, end, q in runs.tolist():
        i = int(np.searchsorted(ends, first, side="right"))
        per_text[i].append((first - (ends[i - 1] if i else 0), end - first, q))
    return per_text


@settings(max_examples=250, deadline=None)
@given(
    st.lists(
        st.lists(
            st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9)), max_size=6
        ).map(lambda parts: [x for word, times in parts for x in word * times]),
        min_size=1,
        max_size=3,
    )
)
def test_all_runs_of_planted_repeats(texts):
    assert own_runs(texts) == [brute_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_all_runs_of_two_words(text):
    assert own_runs([text]) == [brute_runs(text)]


def test_runs_at_large_scales():
    rng = np.random.default_rng(5)
    text = []
    for q in (1, 3, 17, 64, 100, 129):
        text += rng.integers(0, 40, 50).tolist()
        text += (rng.integers(0, 40, q).tolist() * 6)[: 4 * q + q // 2 + 6]
    inner = ([7] * 9 + [8, 9]) * 5  # a run inside each period of a longer one
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = [text, inner * 4, fibonacci[-1], [1] * 700, [1] * 90 + [2] + [1] * 90, []]
    assert own_runs(texts) == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("block", [1, 2, 8, 64])
def test_convolution_finds_every_copy(block):
    rng = np.random.default_rng(block)
    words = rng.integers(0, 2, 600) if block < 8 else np.tile(rng.integers(0, 9, 70), 9)
    starts = np.arange(0, len(words) - block, block)
    at, distance = mismatch_free(words.astype(np.uint64), starts, block)
    wanted = {
        (s, d)
        for s in starts.tolist()
        for d in range(block, 2 * block)
        if s + d + block <= len(words) and (words[s : s + block] == words[s + d : s + d + block]).all()
    }
    found = set(zip(at.tolist(), distance.tolist()))
    assert wanted <= found
    assert len(found) == len(wanted)  # below the prime no sum of these squares is 0 by chance


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute_runs([numbers[w] for w in words])
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_brute_force(spark, small_dir, rows):
    found = sorted(tuple(r) for r in QUERIES["op13_block_convolution_runs"](spark, small_dir).collect())
    wanted = sorted(expected(r[0], r[1]) for r in rows if len(r[1] or "") < 9_000)
    kept = {r[0] for r in wanted}
    assert [r for r in found if r[0] in kept] == wanted
    assert len(found) == len(rows)
    assert any(r[1] for r in wanted)


def test_edges(spark, edge_docs, no_docs):
    found = find_periodic_runs(edge_docs).collect()
    assert len(found) == edge_docs.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in by_id[1] + by_id[2]] == [(0, [], "")] * 2
    assert by_id[3][0] == by_id[3][1]
    assert [tuple(x) for x in by_id[3][0]["runs"]] == [(0, 80, 10)]
    assert by_id[3][0]["collapsed"] == "one two three four five six seven eight nine ten."
    assert by_id[4][0]["collapsed"].endswith("ten. extra")
    assert [tuple(x) for x in by_id[5][0]["runs"]] == [(0, 240_000, 8)]
    assert by_id[6][0]["n_words"] == 0
    assert len(by_id[None]) == 2
    assert find_periodic_runs(no_docs).collect() == []


def test_texts_apart_give_the_same(documents):
    texts = [r["text"].encode() for r in documents.select("text").limit(40).collect()]
    apart = [periods._rows([0], [t]).to_pylist()[0] for t in texts]
    together = periods._rows([0] * len(texts), texts).to_pylist()
    assert apart == together
