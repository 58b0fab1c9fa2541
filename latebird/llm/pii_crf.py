"""Personal data: base patterns, and a skip-chain conditional random field on top.

The base patterns find mail addresses, IP addresses, card and phone numbers. The
field labels the tokens that hold a digit or an @, and the words that are the local
part of an address in the same text, with a kind or none (no other token can be of
these kinds). Neighbouring tokens share chain potentials;
distant tokens that repeat or resemble each other (equal but for case and marks,
same digits, same last seven digits, same local part of an address) share skip
potentials. Occurrences of one key are linked one to the next, so there are
fewer links than tokens and keys. Loopy message passing then carries a label to
the mentions that the patterns miss, as a phone number without its country code.

Weights are learnt by pseudo-likelihood on a bounded sample of documents whose
labels are the base spans. For each span the sample also gets shortened mentions,
labelled with the kind where they are linked to the span and with none where not.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents in the fit; tokens and their signs beyond which a document isn't used for it.
SAMPLE = 2_000
MOST_TOKENS = 400
MOST_SIGNS = 20_000
STEPS, RATE, PENALTY = 400, 0.1, 1e-4
DAMPING = 0.3
#: Messages are passed on while a log message changes by more than this. Loops need
#: not settle: rounds end at `LEAST_ROUNDS` or four for each token of the batch's
#: longest document, whichever is more, which any chain in it settles within.
TOLERANCE, LEAST_ROUNDS, ROUNDS_A_TOKEN = 1e-4, 200, 4
#: The least probability of a label that adds a span.
SURE = 0.9
#: Digits up to which neighbouring tokens of a kind are one span: cards and phones in groups.
MOST_DIGITS = (0, 0, 19, 15)

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails where a run of digits begins fails within the run as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
# From the start of a word only, so that a word without them is read once.
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_WORD = re.compile(r"\S+")
#: Signs of a local part from which on it links an address to its mentions.
LEAST_LOCAL = 5
_EDGES = "\"'`.,;:!?<>[]{}#*$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by start, then kind."""
    found = []
    last = 0
    if "@" in text:
        for m in _AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL_SIGNS:
                start -= 1
            if start < m.start():
                found.append((start, m.end(), 0))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                found.append((m.start(), m.end(), 3))
    found.sort(key=lambda s: (s[0], s[2]))
    return found


def spans_text(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


@dataclass
class Tokens:
    """The tokens of one document that hold a digit or an @."""

    texts: list[str]
    starts: list[int]
    follows: list[bool]  # the token right before this one is the one before it here


def _core(word: str, start: int) -> tuple[str, int]:
    """A word without signs at its edges, and where that begins."""
    core = word.strip(_EDGES)
    return core, start + len(word) - len(word.lstrip(_EDGES))


def tokens(text: str, mentions: bool = False) -> Tokens:
    """Words with a digit or @; with `mentions` also those that are the local part of
    an address in the same text."""
    found = [(m.start(), m.end(), *_core(m.group(), m.start())) for m in _TOKEN.finditer(text)]
    if mentions:
        named = {core.lower().split("@")[0] for _, _, core, _ in found if "@" in core}
        named = {n for n in named if len(n) >= LEAST_LOCAL and not _TOKEN.search(n)}
        if named:
            words = ((m.start(), m.end(), *_core(m.group(), m.start())) for m in _WORD.finditer(text))
            found = sorted(found + [w for w in words if w[2].lower() in named])
    out = Tokens([], [], [])
    end = -1
    for first, last, core, start in found:
        if not core:
            continue
        out.texts.append(core)
        out.starts.append(start)
        out.follows.append(end >= 0 and not text[end:first].strip())
        end = last
    return out


class Spans:
    """Spans by start, asked for those that touch a stretch."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans = spans
        self.starts = [s[0] for s in spans]
        self.furthest = list(accumulate((s[1] for s in spans), max))

    def touching(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """From the last to the first; none before can reach `start` where no end does."""
        i = bisect_left(self.starts, end) - 1
        while i >= 0 and self.furthest[i] > start:
            if self.spans[i][1] > start:
                yield self.spans[i]
            i -= 1


def labels_of(found: Tokens, spans: list[tuple[int, int, int]]) -> list[int]:
    """The label of each token: the kind of the span that covers it."""
    known = Spans(spans)
    touching = (next(known.touching(start, start + len(text)), None) for text, start in zip(found.texts, found.starts))
    return [span[2] + 1 if span else 0 for span in touching]


_FEATURES = 48


def features(text: str) -> list[int]:
    """Numbers of the binary features of a token; each group has a range of its own."""
    digits = sum(c.isdigit() for c in text)
    letters = sum(c.isalpha() for c in text)
    dots, dashes = text.count("."), text.count("-")
    at = text.find("@")
    out = [0, 1 + min(digits, 19)]  # 1-20
    out.append(21 + min(3, (letters + 2) // 3))  # 21-24
    out.append(25 + min(4, dots))  # 25-29
    out.append(30 + min(2, dashes))  # 30-32
    out.append(33 + (at >= 0) + (at > 0 and "." in text[at:]))  # 33-35
    if text[0] == "+":
        out.append(36)
    if text[0] == "(" or text[-1] == ")":
        out.append(37)
    if digits == len(text) and 14 <= digits <= 19:
        out.append(38 if luhn(text) else 39)
    parts = text.split(".")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        out.append(40 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else 41)
    if digits and not letters and dashes == 1:
        out.append(42)
    if letters and digits and at < 0:
        out.append(43)
    if "/" in text or "=" in text or "_" in text:
        out.append(44)
    return out


def keys(text: str) -> set[str]:
    """What a token shares with the tokens that repeat or resemble it."""
    lower = text.lower()
    out = {"=" + lower} if len(lower) >= 5 else set()
    digits = _NOT_DIGITS.sub("", text)
    if len(digits) >= 7:
        out |= {"d" + digits, "7" + digits[-7:]}
    local = lower.split("@")[0]
    if len(local) >= LEAST_LOCAL and not local.isdigit():
        out.add("l" + local)
    return out


def skip_links(texts: list[str]) -> list[tuple[int, int]]:
    """Each token with the last one before it that shares a key, once."""
    last: dict[str, int] = {}
    out = []
    for i, text in enumerate(texts):
        own = keys(text)
        out += [(j, i) for j in sorted({last[k] for k in own if k in last})]
        last.update(dict.fromkeys(own, i))
    return out


class Graph:
    """Token graphs of many documents side by side."""

    def __init__(self) -> None:
        self.feature_rows: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.longest = 0

    def add(self, found: Tokens) -> int:
        """Add a document; the number of its first token."""
        first = len(self.feature_rows)
        self.longest = max(self.longest, len(found.texts))
        self.feature_rows += map(features, found.texts)
        self.chain += [(first + i - 1, first + i) for i, f in enumerate(found.follows) if f]
        self.skip += [(first + a, first + b) for a, b in skip_links(found.texts)]
        return first

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.zeros((len(self.feature_rows), _FEATURES))
        for i, row in enumerate(self.feature_rows):
            x[i, row] = 1.0
        pairs = lambda p: np.array(p, np.int64).reshape(-1, 2)
        return x, pairs(self.chain), pairs(self.skip)


@dataclass
class Field:
    """Log potentials: of features (features x labels), of chain and skip pairs."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit_field(x: np.ndarray, chain: np.ndarray, skip: np.ndarray, y: np.ndarray) -> Field:
    """Weights that make each token's label likely given its neighbours' labels."""
    n, k = len(LABELS), x.shape[1]
    if not len(x):
        return Field(np.zeros((_FEATURES, n)), np.zeros((n, n)), np.zeros((n, n)))
    one = np.eye(n)[y]
    before, after, linked = (np.zeros((len(x), n)) for _ in range(3))
    np.add.at(before, chain[:, 1], one[chain[:, 0]])
    np.add.at(after, chain[:, 0], one[chain[:, 1]])
    np.add.at(linked, skip[:, 1], one[skip[:, 0]])
    np.add.at(linked, skip[:, 0], one[skip[:, 1]])
    unary, pair, link = np.zeros((k, n)), np.zeros((n, n)), np.zeros((n, n))
    state = [np.zeros((k + 2 * n, n)) for _ in range(2)]
    for step in range(1, STEPS + 1):
        scores = x @ unary + before @ pair + after @ pair.T + linked @ link
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        slope = (p / p.sum(axis=1, keepdims=True) - one) / len(x)
        by_link = linked.T @ slope
        slopes = np.concatenate(
            (x.T @ slope, before.T @ slope + (after.T @ slope).T, (by_link + by_link.T) / 2)
        )
        slopes += PENALTY * np.concatenate((unary, pair, link))
        state[0] = 0.9 * state[0] + 0.1 * slopes
        state[1] = 0.99 * state[1] + 0.01 * slopes**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        unary, pair, link = unary - move[:k], pair - move[k : k + n], link - move[k + n :]
    return Field(unary, pair, link)


def marginals(
    field: Field, x: np.ndarray, chain: np.ndarray, skip: np.ndarray, longest: int | None = None
) -> np.ndarray:
    """Label probabilities of each token by loopy sum-product message passing.

    Only messages at tokens where something changed are sent again, so a long chain
    costs its length and not that of the batch each round. `longest`: tokens of the
    longest document."""
    belief = x @ field.unary
    ends = np.concatenate((chain, skip))
    if len(ends):
        kind = np.repeat([0, 1], [len(chain), len(skip)])
        potentials = np.stack((field.chain, field.skip))  # kinds x first x second
        down, up = (np.zeros((len(ends), len(LABELS))) for _ in range(2))
        active = np.arange(len(ends))
        for _ in range(max(LEAST_ROUNDS, ROUNDS_A_TOKEN * (len(x) if longest is None else longest))):
            first, second = ends[active, 0], ends[active, 1]
            tie = potentials[kind[active]]
            change_down = (1 - DAMPING) * (_sent((belief[first] - up[active])[:, :, None] + tie, 1) - down[active])
            change_up = (1 - DAMPING) * (_sent((belief[second] - down[active])[:, None, :] + tie, 2) - up[active])
            down[active] += change_down
            up[active] += change_up
            np.add.at(belief, second, change_down)
            np.add.at(belief, first, change_up)
            moved = np.zeros(len(x), bool)
            moved[second[np.abs(change_down).max(axis=1) > TOLERANCE]] = True
            moved[first[np.abs(change_up).max(axis=1) > TOLERANCE]] = True
            if not moved.any():
                break
            active = np.flatnonzero(moved[ends[:, 0]] | moved[ends[:, 1]])
    belief -= belief.max(axis=1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


def _sent(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    out = np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)
    return out - out.max(axis=1, keepdims=True)


def shortened(text: str, kind: int) -> str | None:
    """A mention of a span that the base pattern misses."""
    if kind == 0:
        return text.split("@")[0]
    if kind == 3:
        last = text.split()[-1]
        return last if len(_NOT_DIGITS.sub("", last)) >= 7 else None
    return None


def training_graph(documents: list[tuple[Tokens, list[int]]]) -> tuple[Graph, np.ndarray]:
    """The documents' graph and labels, with shortened mentions of their spans."""
    graph, y = Graph(), []
    for found, labels in documents:
        extra = []
        for text, label in zip(found.texts, labels):
            short = shortened(text, label - 1) if label else None
            if short and short != text or short and label == 4:
                extra.append((short, label))
        texts = found.texts + [t for t, _ in extra]
        graph.add(Tokens(texts, [0] * len(texts), found.follows + [False] * len(extra)))
        y += labels + [label for _, label in extra]
        for short, _ in extra:  # the same mention with nothing to link to
            graph.add(Tokens([short], [0], [False]))
            y.append(0)
    return graph, np.array(y, np.int64)


def added_spans(
    found: Tokens, probabilities: np.ndarray, base: list[tuple[int, int, int]]
) -> list[tuple[int, int, int]]:
    """Runs of tokens with one sure kind, where no base span is."""
    taken = Spans(base)
    out: list[tuple[int, int, int]] = []
    best = probabilities.argmax(axis=1)
    sure = (best > 0) & (probabilities.max(axis=1) >= SURE)
    open_, digits = -1, 0
    for i, (text, start) in enumerate(zip(found.texts, found.starts)):
        end = start + len(text)
        if not sure[i] or next(taken.touching(start, end), None):
            continue
        size = len(_NOT_DIGITS.sub("", text))
        most = MOST_DIGITS[best[i] - 1]
        if open_ == i - 1 >= 0 and found.follows[i] and best[i] == best[i - 1] and digits + size <= most:
            out[-1] = (out[-1][0], end, out[-1][2])
            digits += size
        else:
            out.append((start, end, int(best[i]) - 1))
            digits = size
        open_ = i
    return out


_FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string, n_added long"
)
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
_PLAIN = "[0-9@]"


def fit_from(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """The field from the `sample` documents with a digit or @ and the smallest
    hashes of doc_id. The driver gets their tokens and labels, not their texts."""
    spark = docs.sparkSession
    ship_package(spark)
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike(_PLAIN)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    chosen = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = tokens(text)
                if len(found.texts) <= MOST_TOKENS and sum(map(len, found.texts)) <= MOST_SIGNS:
                    rows.append((doc_id, found.texts, found.follows, labels_of(found, base_spans(text))))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32()))
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "texts", "follows", "labels"])

    rows = (
        known.join(F.broadcast(chosen), "doc_id")  # `sample` ids at most
        .mapInArrow(
            read, "doc_id long, texts array<string>, follows array<boolean>, labels array<int>"
        )
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    graph, y = training_graph(
        [(Tokens(list(r["texts"]), [], list(r["follows"])), list(r["labels"])) for r in rows]
    )
    return fit_field(*graph.arrays(), y)


def find_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): the counts and digest of the base
    spans, and all spans, in code points with exclusive ends.

    Null text is empty text and has no span. A null doc_id stays null; such rows
    are searched but not used for the fit. Repeated rows give equal rows. Other
    columns are not looked at. An empty table gives no rows.
    """
    field = fit_from(docs, sample)
    nothing = hashlib.sha256(b"").hexdigest()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            n = len(ids)
            counts = np.zeros((4, n), np.int64)
            digests, spans, added = [nothing] * n, [""] * n, np.zeros(n, np.int64)
            graph, held = Graph(), []
            places = np.flatnonzero(
                pc.match_substring_regex(batch.column(1), _PLAIN).to_numpy(zero_copy_only=False)
            )
            for i in places.tolist():
                text = batch.column(1)[i].as_py()
                base = base_spans(text)
                for _, _, kind in base:
                    counts[kind, i] += 1
                if base:
                    spans[i] = spans_text(base)
                    digests[i] = hashlib.sha256(spans[i].encode()).hexdigest()
                found = tokens(text, mentions=True)
                if found.texts:
                    held.append((i, graph.add(found), found, base))
            if held:
                p = marginals(field, *graph.arrays(), graph.longest)
                for i, first, found, base in held:
                    more = added_spans(found, p[first : first + len(found.texts)], base)
                    if more:
                        added[i] = len(more)
                        spans[i] = spans_text(sorted(base + more, key=lambda s: (s[0], s[2])))
            columns = [ids, *map(pa.array, counts), pa.array(digests, pa.string())]
            columns += [pa.array(spans, pa.string()), pa.array(added)]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    ).mapInArrow(search, _FOUND)
