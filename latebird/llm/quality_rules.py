"""Quality rules whose cutoffs carry a guarantee against rejecting good documents.

Four measures of a text can reject it when above a cutoff. Cutoffs are set for
each stratum (language) on labelled texts that pass the base rules, in two halves
by the hash of the text. A text counts once, however many documents are copies of
it, so that the draws of a half differ and no text stands in both:

- On the tuning half, the candidate of each rule is the cutoff from a fixed grid
  that rejects the most bad documents less `GOOD_WEIGHT` times the good ones.
- On the holdout half, the grid is walked from its most lenient cutoff towards
  the candidate. A cutoff passes if the exact binomial tail P(X <= k) of the k
  good documents it rejects, with X ~ Bin(n, risk of the rule), is at most the
  rule's level; the walk ends at the first that fails. Such a fixed order needs
  no correction over the grid. Over all strata and rules the level is divided
  (Bonferroni), and a stratum's risk is divided over its rules.

So with probability 1 - `level`, no stratum loses more than `risk` of its good
texts, taken as drawn one by one; near copies, which differ somewhere, count each. Strata with fewer labels than could pass any test are joined, before
their values are seen; where even that is too few, no cutoff is set.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import ship_package, staged, text_or_empty

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

_SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02)
#: Rule -> its measure in SQL and its grid of cutoffs, the most lenient first.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (3.0, 2.5, 2.0, 1.5, 1.0, 0.75, *_SHARES[4:])),
    "repeats": ("n_repeat_words / n_words", _SHARES),
    "lines": ("n_dup_lines / n_lines", _SHARES),
    "capitals": ("n_upper_words / n_words", _SHARES),
}
GOOD_WEIGHT = 5
JOINED = "*"

_COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper_words",
)


def measure(text: str) -> tuple[int, ...]:
    """The counts of a text, in the order of _COUNTS."""
    words = text.encode().split()  # bytes.split() parts at exactly the six blanks
    n = len(words)
    dup_lines = lines = 0
    seen = set()
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            if line in seen:
                dup_lines += 1
            else:
                seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(windows) < n - 2:
        covered = 0  # words before this place are counted already
        for i, window in enumerate(zip(words, words[1:], words[2:])):
            if windows[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return (
        n,
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeated,
        lines,
        sum(word.isupper() for word in words),
    )


def measured(docs: DataFrame, stratum: Column | None = None) -> DataFrame:
    """doc_id, stratum, hash of the text and the counts of every row of `docs` (doc_id, text, lang)."""
    ship_package(docs.sparkSession)
    names = ["doc_id", "stratum", "text_hash", *_COUNTS]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(text.as_py()) for text in batch.column(3)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names)

    by = F.col("lang") if stratum is None else stratum
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(by.cast("string"), F.lit("(none)")).alias("stratum"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        text_or_empty().alias("text"),
    ).mapInArrow(
        count, "doc_id long, stratum string, text_hash long, " + ", ".join(f"{c} long" for c in _COUNTS)
    )


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p)."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    choose = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
    return min(1.0, math.fsum(math.exp(choose(i) + i * log_p + (n - i) * log_q) for i in range(k + 1)))


@dataclass(frozen=True)
class Cutoffs:
    """For each stratum: rule -> cutoff, above which a document is rejected."""

    by_stratum: dict[str, dict[str, float]]

    def verdict(self) -> Column:
        """The first rule that rejects a measured row; null where none does."""
        out = F.lit(None).cast("string")
        for rule in reversed(RULES):
            pairs = [
                F.lit(x) for s, cuts in self.by_stratum.items() if rule in cuts for x in (s, cuts[rule])
            ]
            if not pairs:
                continue
            named = [F.lit(x) for s in self.by_stratum for x in (s, True)]
            known = F.coalesce(F.create_map(*named)[F.col("stratum")], F.lit(False))
            group = F.when(known, F.col("stratum")).otherwise(F.lit(JOINED))
            out = F.when(F.expr(RULES[rule][0]) > F.create_map(*pairs)[group], F.lit(rule)).otherwise(out)
        return out


def certify(
    counts: dict[tuple[str, str, int, bool, bool], int],
    risk: float,
    level: float,
) -> Cutoffs:
    """Cutoffs from (stratum, rule, grid cutoffs exceeded, good, holdout) -> documents."""
    rule_risk = risk / len(RULES)
    good_of: Counter = Counter()
    for (stratum, rule, _, good, held), n in counts.items():
        if good and held and rule == next(iter(RULES)):
            good_of[stratum] += n
    # With no good document rejected, n of them pass a test if (1 - risk)^n <= level.
    needed = lambda tests: math.log(level / tests) / math.log1p(-rule_risk)
    own = {s for s, n in good_of.items() if n >= needed(len(RULES) * (len(good_of) + 1))}
    joined: dict[tuple, int] = defaultdict(int)
    for (stratum, *rest), n in counts.items():
        joined[(stratum if stratum in own else JOINED, *rest)] += n
    strata = sorted({key[0] for key in joined})
    test_level = level / (len(RULES) * max(1, len(strata)))
    chosen: dict[str, dict[str, float]] = {s: {} for s in strata}
    for stratum in strata:
        for rule, (_, grid) in RULES.items():

            def above(place: int, good: bool, held: bool) -> int:
                """Documents beyond the cutoff at `place` of the grid."""
                return sum(
                    joined.get((stratum, rule, e, good, held), 0)
                    for e in range(len(grid) - place, len(grid) + 1)
                )

            gains = [
                above(i, False, False) - GOOD_WEIGHT * above(i, True, False) for i in range(len(grid))
            ]
            if max(gains) <= 0:
                continue
            candidate = gains.index(max(gains))
            n = sum(joined.get((stratum, rule, e, True, True), 0) for e in range(len(grid) + 1))
            for i in range(candidate + 1):
                if not n or binomial_tail(above(i, True, True), n, rule_risk) > test_level:
                    break
                chosen[stratum][rule] = grid[i]
    return Cutoffs(chosen)


def fit_cutoffs(
    counted: DataFrame, labels: DataFrame, risk: float = 0.05, level: float = 0.05
) -> Cutoffs:
    """Cutoffs for `counted` (see measured) from `labels` (doc_id, quality 0/1).

    What comes to the driver is one count per stratum, rule and grid step.
    Repeated labels of a document count once, the lowest; null ones don't count.
    Of several texts of a doc_id the one with the smallest hash is the labelled
    one. Copies of a text count once, with the lowest of their labels and the
    first of their strata.
    """
    judged = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    of_text = F.struct("text_hash", "stratum", *_COUNTS)
    chosen = counted.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(of_text).alias("t"))
    rows = (
        chosen.join(judged, "doc_id")
        .groupBy("t.text_hash")
        .agg(F.min("t").alias("t"), F.min("quality").alias("quality"))
        .select("t.*", "quality")
        .where(~base_failed())
    )
    exceeded = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum(((F.expr(sql) > c).cast("int") for c in grid), F.lit(0)).alias("exceeded"),
        )
        for rule, (sql, grid) in RULES.items()
    ]
    found = (
        rows.select(
            "stratum",
            (F.col("quality") > 0).alias("good"),
            (F.pmod(F.xxhash64("text_hash"), F.lit(2)) == 1).alias("held"),
            F.explode(F.array(*exceeded)).alias("e"),
        )
        .groupBy("stratum", "e.rule", "e.exceeded", "good", "held")
        .count()
        .collect()
    )
    return certify(
        {(r["stratum"], r["rule"], r["exceeded"], r["good"], r["held"]): r["count"] for r in found},
        risk,
        level,
    )


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, risk: float = 0.05, level: float = 0.05
) -> DataFrame:
    """One row per row of `docs`: the counts, base_failed, kept, and the rule that rejected it.

    Null text has no words and fails the base rules. A null language is a
    stratum of its own; a null doc_id is judged but never serves as a label's
    document. Repeated rows and copies of a text give a row each and count once
    for the cutoffs.
    Without labels only the base rules reject. An empty table gives no rows.
    """
    counted = staged(measured(docs), "quality-counts")
    cutoffs = fit_cutoffs(counted, labels, risk, level)
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("rejected_by", F.when(~F.col("base_failed"), cutoffs.verdict()))
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
        .drop("text_hash")
    )
