"""Quality classifier: cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades; ordered thresholds
part them:

    P(grade <= k) = sigmoid(threshold_k - w.x),   threshold_0 < threshold_1 < ...

The features of a text are sets: its words, their first 4 and 5 letters, the
signs at their ends, and the share of distinct words at the text's length, all hashed to
`BUCKETS`. Features take part if a likelihood-ratio test ties them to the grade.
The model is fitted on a bounded sample of labelled rows (parameter
`sample`, by the hash of doc_id), in which copies of a text count once, so that
no held-out text has been fitted, and gives the expected grade and the tail
probability P(grade >= top), on which documents are selected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, staged, text_or_empty, unused_name

BUCKETS = 1 << 22
#: Labelled documents in the fit; the fewest of them in which a feature stands, and
#: the least likelihood-ratio statistic that ties it to the grade.
SAMPLE = 16_000
LEAST_DOCUMENTS = 5
LEAST_RATIO = 20.0
#: The least difference in log odds of a feature's presence between neighbouring grades.
LEAST_LOG_ODDS = 2.0
#: Passes of coordinate descent, and the penalty on the sum of absolute weights.
PASSES = 40
PENALTY = 1.0
#: Every so many labelled documents one is held out to set the cut.
HELD_OUT = 5
#: In setting the cut, a share of the top grade lost weighs so many times a share of the rest caught.
CLEAN_WEIGHT = 3.0
REMEMBERED = 200_000
#: Marks around a word that are no part of it.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def word_features(word: str) -> tuple[int, ...]:
    core = word.strip(MARKS) or word
    found = [_bucket("w" + core)]
    if len(core) > 4:
        found.append(_bucket("p" + core[:4]))
    if len(core) > 5:
        found.append(_bucket("q" + core[:5]))
    if len(word) > 2 and not word[-2].isalnum():
        found.append(_bucket("t" + word[-2:]))
    return tuple(found)


def form_feature(words: int, distinct: int) -> int:
    return _bucket(f"form {words.bit_length()} {20 * distinct // max(1, words)}")


class _Memory(dict):
    """word -> its features among the wanted ones; starts anew when full."""

    def __init__(self, wanted: dict[int, float] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        found = word_features(word)
        if self.wanted is not None:
            found = tuple(x for x in found if x in self.wanted)
        self[word] = found
        return found


def text_features(text: str, memory: _Memory) -> set[int]:
    words = text.lower().split()
    distinct = set(words)
    found = {form_feature(len(words), len(distinct))}
    for features in map(memory.__getitem__, distinct):
        found.update(features)
    return found


@dataclass
class OrdinalModel:
    """Weights of the buckets that have one; thresholds between grades; the cut on the tail."""

    weights: dict[int, float]
    thresholds: np.ndarray
    cut: float

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -50, 50)))


def _counts(features: np.ndarray, n: int) -> np.ndarray:
    """np.bincount, a stretch at a time: it copies its input to wide integers."""
    total = np.zeros(n, np.int32)
    for at in range(0, len(features), 1 << 20):
        total += np.bincount(features[at : at + (1 << 20)], minlength=n).astype(np.int32)
    return total


def likelihood_ratio(
    features: np.ndarray, grades: np.ndarray, of_grade: np.ndarray, n: int
) -> np.ndarray:
    """The G statistic of the presence of each of `n` features against the grade, 0
    where the odds of presence are alike in all grades; `of_grade`: documents of each."""
    return ratio_of_counts(
        np.stack([_counts(features[grades == g], n) for g in range(len(of_grade))]), of_grade
    )


def ratio_of_counts(with_feature: np.ndarray, of_grade: np.ndarray) -> np.ndarray:
    """`likelihood_ratio` from the documents of each grade (rows) with each feature (columns)."""
    with_feature = with_feature.astype(float)
    without = of_grade[:, None] - with_feature
    total = 0.0
    for observed in (with_feature, without):
        expected = observed.sum(axis=0) * of_grade[:, None] / max(1, of_grade.sum())
        total = total + observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9))
    # The widest step in the odds of presence between two neighbouring grades.
    odds = np.log((with_feature + 0.5) / (without + 0.5))
    steep = np.abs(np.diff(odds, axis=0)).max(axis=0, initial=0.0)
    return np.where(steep >= LEAST_LOG_ODDS, 2 * total.sum(axis=0), 0.0)


def _slopes(scores, grades, thresholds):
    """First and second derivative of the negative log-likelihood by each score."""
    ends = np.concatenate(([-np.inf], thresholds, [np.inf]))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    upper, lower = sigmoid(ends[grades + 1] - scores), sigmoid(ends[grades] - scores)
    return 1 - upper - lower, upper * (1 - upper) + lower * (1 - lower)


def _fit_thresholds(scores, grades, thresholds):
    """Each threshold moved to where it parts as many documents as are below it."""
    out = thresholds.copy()
    for j in range(len(out)):
        below = (grades <= j).mean()
        low, high = out[j] - 8.0, out[j] + 8.0
        for _ in range(40):
            middle = (low + high) / 2
            if (1 / (1 + np.exp(np.clip(scores - middle, -40, 40)))).mean() < below:
                low = middle
            else:
                high = middle
        out[j] = middle
    return np.maximum.accumulate(out + np.arange(len(out)) * 1e-6)


def fit_ordinal(
    features: np.ndarray, counts: np.ndarray, grades: np.ndarray, n_grades: int
) -> OrdinalModel:
    """The model from the buckets of all documents, one document after another,
    `counts` of them each, and grades 0 to n_grades - 1."""
    thresholds = np.zeros(n_grades - 1)
    if not len(grades):  # nothing is known: every text has an even chance, none is rejected
        return OrdinalModel({}, thresholds, 0.0)
    n = len(grades)
    held = np.arange(n) % HELD_OUT == HELD_OUT - 1
    owner = np.repeat(np.arange(n, dtype=np.int32), counts)
    # From here on features are numbered from 0, without the rare ones.
    frequent = _counts(features[~held[owner]], BUCKETS) >= LEAST_DOCUMENTS
    buckets = np.flatnonzero(frequent).astype(np.int32)
    known = frequent[features]
    owner = owner[known]
    features = np.searchsorted(buckets, features[known]).astype(np.int32)
    fitted = ~held[owner]
    of_grade = np.bincount(grades[~held], minlength=n_grades)
    ratio = likelihood_ratio(features[fitted], grades[owner[fitted]], of_grade, len(buckets))
    used = fitted & (ratio >= LEAST_RATIO)[features]
    by_feature = np.argsort(features[used], kind="stable")
    names, starts = np.unique(features[used][by_feature], return_index=True)
    documents = np.split(owner[used][by_feature], starts[1:]) if len(names) else []
    share = (np.cumsum(of_grade)[:-1] + 0.5) / (of_grade.sum() + 1)
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(n_grades - 1) * 1e-3)
    scores = np.zeros(n)
    weights = np.zeros(len(buckets))
    order = np.argsort(-ratio[names], kind="stable")  # the strongest ties first
    for _ in range(PASSES):
        moved = 0.0
        for j in order:
            who, w = documents[j], weights[names[j]]
            slope, bend = _slopes(scores[who], grades[who], thresholds)
            bend = bend.sum() + 1e-2
            free = w * bend - slope.sum()
            new = np.sign(free) * max(0.0, abs(free) - PENALTY) / bend
            step = float(np.clip(new - w, -1, 1))
            if step:
                weights[names[j]] = w + step
                scores[who] += step
                moved = max(moved, abs(step))
        thresholds = _fit_thresholds(scores[~held], grades[~held], thresholds)
        if moved < 0.02:
            break
    kept = np.flatnonzero(weights)
    model = OrdinalModel(dict(zip(buckets[kept].tolist(), weights[kept].tolist())), thresholds, 0.5)
    scores = np.bincount(owner, weights[features], minlength=n)
    tails, top = model.tails(scores)[held, -1], grades[held] == n_grades - 1
    cuts = np.unique(tails)
    if top.any() and not top.all():
        lost = np.searchsorted(np.sort(tails[top]), cuts) / top.sum()
        caught = np.searchsorted(np.sort(tails[~top]), cuts) / (~top).sum()
        model.cut = float(cuts[np.argmax(caught - CLEAN_WEIGHT * lost)]) - 1e-9
    return model


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels (doc_id, quality, toxic): 0 for low quality, 1
    for toxic text of good quality, 2 for the rest. Null quality gives no grade,
    null toxic counts as not toxic; of several labels the lowest grade counts."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    return (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(grade).cast("int").alias("grade"))
    )


def fit_quality(
    docs: DataFrame, grades: DataFrame, n_grades: int = 3, sample: int = SAMPLE
) -> OrdinalModel:
    """Fit on the `sample` graded documents with the smallest hashes of doc_id.

    Of several texts of a doc_id the one with the smallest hash is the graded one.
    Copies of a text are one document, that of the smallest doc_id, with the lowest
    of their grades.

    Features are counted by grade on the executors. What comes to the driver is
    the counts of those that are not rare, then the documents' features that are
    tied to the grade: the model is the same as from all features.
    """
    ship_package(docs.sparkSession)
    known = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    )
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory()
        for batch in batches:
            found = [
                np.fromiter(sorted(text_features(t.as_py(), memory)), "<i4").tobytes()
                for t in batch.column(2)
            ]
            columns = [batch.column(3), batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["text_hash", "doc_id", "grade", "features"])

    schema = "doc_id long, grade int, features binary"
    graded_rows = (
        known.join(F.broadcast(chosen), "doc_id")  # `sample` ids at most
        .select("doc_id", "grade", "text", F.xxhash64("text").alias("text_hash"))
        .mapInArrow(featurize, "text_hash long, " + schema)
    )
    of_id = graded_rows.groupBy("doc_id").agg(F.min(F.struct("text_hash", "grade", "features")).alias("t"))
    featured = staged(
        of_id.groupBy("t.text_hash")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min("t.grade").alias("grade"),
            F.min("t.features").alias("features"),
        )
        .select("doc_id", "grade", "features"),
        "quality-features",
    )
    ids = featured.select("doc_id", "grade").toArrow().sort_by("doc_id")
    held = np.arange(len(ids)) % HELD_OUT == HELD_OUT - 1  # as in fit_ordinal
    held_ids = set(ids.column("doc_id").to_numpy()[held].tolist())
    names = [f"n{g}" for g in range(n_grades)]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_grades, BUCKETS), np.int32)
        for batch in batches:
            for doc_id, grade, found in zip(*(c.to_pylist() for c in batch.columns)):
                if doc_id not in held_ids:
                    total[grade, np.frombuffer(found, "<i4")] += 1  # a document's features differ
        seen = np.flatnonzero(total.any(axis=0)).astype(np.int32)
        for at in range(0, len(seen), 1 << 16):
            part = seen[at : at + (1 << 16)]
            columns = [pa.array(part), *(pa.array(total[g, part]) for g in range(n_grades))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    counted = (
        featured.mapInArrow(count, ", ".join(f"{c} int" for c in ("bucket", *names)))
        .groupBy("bucket")
        .agg(*(F.sum(c).alias(c) for c in names))
        .where(" + ".join(names) + f" >= {LEAST_DOCUMENTS}")
        .toArrow()
    )
    of_grade = np.bincount(ids.column("grade").to_numpy()[~held], minlength=n_grades)
    ratio = ratio_of_counts(np.stack([counted.column(c).to_numpy() for c in names]), of_grade)
    tied = np.sort(counted.column("bucket").to_numpy()[ratio >= LEAST_RATIO])

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (np.frombuffer(f, "<i4") for f in batch.column(2).to_pylist())
            kept = pa.array([f[np.isin(f, tied)].tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], kept], names=batch.schema.names)

    rows = featured.mapInArrow(pick, schema).toArrow().sort_by("doc_id")
    packed = rows.column("features").combine_chunks()
    if isinstance(packed, pa.ChunkedArray):
        packed = packed.chunk(0) if packed.num_chunks else pa.array([], pa.binary())
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False)
    data = (packed.buffers()[2] if len(packed) else None) or b""
    return fit_ordinal(
        np.frombuffer(data, "<i4", int(sizes.sum()) // 4),
        sizes // 4,
        rows.column("grade").to_numpy(),
        n_grades,
    )


def _scorer(model: OrdinalModel):
    """A column function: text -> (expected_grade, tails, has words)."""
    weights, cut = model.weights, model.cut

    @F.pandas_udf("expected_grade double, tail double, kept boolean")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = _Memory(weights)
        weight = lambda x: weights.get(x, 0.0)
        for texts in batches:
            scores = np.fromiter(
                (sum(map(weight, text_features(t, memory))) for t in texts), float, len(texts)
            )
            tails = model.tails(scores)
            wordy = texts.str.contains(r"\S", regex=True).to_numpy(bool)
            tails[~wordy] = 0.0
            yield pd.DataFrame(
                {
                    "expected_grade": tails.sum(axis=1),
                    "tail": tails[:, -1],
                    "kept": wordy & (tails[:, -1] >= cut),
                }
            )

    return score


def grade_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, expected_grade, tail (P of the top grade) and kept for every row of `docs`.

    A null or wordless text has grade 0 and isn't kept. A null doc_id stays
    null. Repeated rows get equal verdicts and count once in the fit. Other
    columns are not looked at. Without labels nothing with words is rejected.
    An empty table gives no rows.
    """
    model = fit_quality(docs, graded(labels), sample=sample)
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _scorer(model)(text_or_empty()).alias("s")
    )
    return scored.select("doc_id", "s.expected_grade", "s.tail", "s.kept")


def select_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    model = fit_quality(docs, graded(labels), sample=sample)
    name = unused_name(docs, "quality_verdict")
    scored = docs.withColumn(name, _scorer(model)(text_or_empty()))
    return scored.where(F.col(f"{name}.kept")).select(*docs.columns)
