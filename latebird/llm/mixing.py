"""Mixing sources to target weights: raking, then sampling with calibrated probabilities.

Tokens are counted by cell (source, language, topic). Iterative proportional
fitting scales the cells' weights in turn to the target share of each source,
each language and each topic. All of it is window functions over the cell table,
whose size is the number of combinations that occur, not of documents. After every
few rounds the marginals are measured, and the fitting ends when each is at its
target up to a tolerance. Targets that no weights can meet, because combinations
are missing, are approached only: the fitting then ends after a stated number of
rounds with a warning that says how far off it is. (A fit that comes no nearer for a
while may still get there, so nothing earlier ends it.)

A dimension's target is the observed share to a power below 1 (which lifts rare
values), or a given weight for named values; both are normalised to sum to 1.

A cell's sampling rate is its raked weight over its observed share. With a
budget of tokens, documents of a cell are kept with probability min(1, c * rate),
c being such that the expected tokens equal the budget; a cell at 1 gives all it
has. The draw is a hash of doc_id, so it can be repeated.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latebird.llm.common import staged, unused_name

NONE = "(none)"
#: Rounds of fitting that make one written step, after which the marginals are measured.
ROUNDS_A_STEP = 5
#: Rounds in the check SQL, which can't measure.
CHECK_ROUNDS = 20


@dataclass(frozen=True)
class Mix:
    """Targets and budget: powers by dimension, weights of named values, share of all
    tokens; the largest deviation of a marginal, as a share of its target, with which
    the fitting ends, and the rounds after which it ends in any case."""

    powers: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.5, "lang": 0.7, "topic": 0.8}
    )
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    budget: float = 0.5
    seed: int = 7
    tolerance: float = 1e-9
    most_rounds: int = 200


#: The same expressions in Spark and in the check SQL.
TOPIC = (
    "CASE WHEN text IS NULL THEN '(none)'"
    " WHEN 12 * (length(text) - length(replace(text, '|', ''))) > length(text) THEN 'table'"
    " WHEN 12 * (length(text) - length(translate(text, '#*$%&', ''))) > length(text) THEN 'markup'"
    " WHEN length(text) < 1000 THEN 'short prose'"
    " WHEN length(text) < 5000 THEN 'prose'"
    " ELSE 'long prose' END"
)


def words() -> Column:
    """Words of a text: runs of signs other than blanks."""
    return F.coalesce(F.regexp_count("text", F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def topic() -> Column:
    """The form of a text: table, markup, or prose of three lengths."""
    return F.expr(TOPIC)


def _target(name: str, mix: Mix) -> str:
    """SQL for the unnormalised target of a cell's value in one dimension."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    power = f"pow(share_{name}, {float(mix.powers[name])!r})"
    given = mix.weights.get(name, {})
    if not given:
        return power
    cases = " ".join(f"WHEN {quote(v)} THEN {float(w)!r}" for v, w in sorted(given.items()))
    return f"CASE {name} {cases} ELSE {power} END"


def fit_cells(cells: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """`cells` (the dimensions, tokens > 0; one row each) with weight and probability."""
    names = list(mix.powers)
    one = cells.coalesce(1)  # a few rows per combination: one task needs no exchange
    everything = Window.partitionBy(F.lit(1))
    by = {d: Window.partitionBy(d) for d in names}
    total = F.sum("tokens").over(everything)
    one = one.withColumns(
        {f"share_{d}": F.sum("tokens").over(by[d]) / total for d in names}
        | {"share": F.col("tokens") / total, "weight": F.col("tokens") / total}
    )
    one = one.withColumns({f"raw_{d}": F.expr(_target(d, mix)) for d in names})
    one = one.withColumns(  # each value counts once: its cells' shares sum to its own
        {
            f"target_{d}": F.col(f"raw_{d}")
            / F.sum(F.col(f"raw_{d}") * F.col("share") / F.col(f"share_{d}")).over(everything)
            for d in names
        }
    )
    # A value of target 0 has no weight from the first round on.
    ratio = lambda a, b: F.try_divide(a, b)
    done = 0
    while True:
        for _ in range(ROUNDS_A_STEP):
            for d in names:
                scale = ratio(F.col(f"target_{d}"), F.sum("weight").over(by[d]))
                one = one.withColumn("weight", F.col("weight") * F.coalesce(scale, F.lit(0.0)))
        one = staged(one, "cells").coalesce(1)
        off = [F.abs(ratio(F.sum("weight").over(by[d]), F.col(f"target_{d}")) - 1) for d in names]
        worst = one.select(F.array_max(F.array(*off)).alias("off")).agg(F.max("off")).first()[0]
        done += ROUNDS_A_STEP
        if worst is None or worst <= mix.tolerance:
            break
        if done >= mix.most_rounds:
            warnings.warn(f"marginals are off by up to {worst:.2g} after {done} rounds", stacklevel=2)
            break
    one = one.withColumn("rate", F.col("weight") / F.col("share"))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("rate"), *names)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    left = ratio(
        F.lit(float(mix.budget)) - sum_before("share"),
        F.sum("weight").over(everything) - sum_before("weight"),
    )
    one = one.withColumn("scale_here", left)
    # Cells from the highest rate on give all they have while the scale would pass 1.
    free = F.when(F.col("scale_here") * F.col("rate") <= 1, F.col("scale_here"))
    one = one.withColumn("scale", F.first(free, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ))
    p = F.least(F.lit(1.0), F.coalesce(F.col("scale") * F.col("rate"), F.lit(1.0)))
    p = F.when(F.col("rate") == 0, 0.0).otherwise(p)
    return one.select(*names, "tokens", "share", "weight", p.alias("probability"))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from a document's id, or from its text where that is null."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("none "), F.md5(text)))
    digest = F.md5(F.concat(named, F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def _marked(docs: DataFrame, mix: Mix) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with dimension and token columns under names the input doesn't have."""
    given = {"topic": topic(), "tokens": words()}
    names = {d: unused_name(docs, f"mix_{d}") for d in (*mix.powers, "tokens")}
    value = lambda d: given[d] if d in given else F.col(d)
    marked = docs.withColumns(
        {
            names[d]: value(d) if d == "tokens" else F.coalesce(value(d).cast("string"), F.lit(NONE))
            for d in names
        }
    )
    return marked, names


def sample_mix(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The sampled rows of `docs` (doc_id, text, lang, source, ...), all columns,
    and mix_topic, mix_tokens and mix_probability (with underscores added where
    the input has such columns).

    A null source or language is a value of its own; null text is topic
    "(none)" of no tokens. Documents without words have no tokens to mix and
    are not sampled. Rows with one doc_id are drawn together, and of those with
    a null one the rows with one text. A value whose weight is 0 gives none.
    An empty table gives no rows.
    """
    marked, names = _marked(docs, mix)
    tokens = names.pop("tokens")
    cells = (
        marked.groupBy(*[F.col(names[d]).alias(d) for d in names])
        .agg(F.sum(tokens).alias("tokens"))
        .where("tokens > 0")
    )
    p = unused_name(docs, "mix_probability")
    fitted = staged(fit_cells(staged(cells, "cells"), mix), "cells").select(
        *[F.col(d).alias(names[d]) for d in names], F.col("probability").alias(p)
    )
    joined = marked.where(F.col(tokens) > 0).join(fitted, list(names.values()))
    kept = joined.where(draw(F.col("doc_id"), F.col("text"), mix.seed) < F.col(p))
    return kept.select(*docs.columns, names["topic"], tokens, p)


def check_sql(mix: Mix = Mix()) -> str:
    """Check SQL for `sample_mix`: doc_id, source, lang, topic, tokens, probability."""
    names = list(mix.powers)
    dims = ", ".join(names)
    steps = [
        "docs AS (SELECT doc_id, text, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, "
        f"{TOPIC} AS topic, CAST(coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS BIGINT) "
        "AS tokens FROM documents)",
        f"cells AS (SELECT {dims}, sum(tokens) AS tokens FROM docs GROUP BY {dims} HAVING sum(tokens) > 0)",
        "shares AS (SELECT *, tokens / sum(tokens) OVER () AS share, "
        + ", ".join(
            f"sum(tokens) OVER (PARTITION BY {d}) / sum(tokens) OVER () AS share_{d}" for d in names
        )
        + " FROM cells)",
        "raw AS (SELECT *, " + ", ".join(f"{_target(d, mix)} AS raw_{d}" for d in names) + " FROM shares)",
        "fit0 AS (SELECT *, share AS weight, "
        + ", ".join(f"raw_{d} / sum(raw_{d} * share / share_{d}) OVER () AS target_{d}" for d in names)
        + " FROM raw)",
    ]
    n = 0
    for _ in range(CHECK_ROUNDS):
        for d in names:
            steps.append(
                f"fit{n + 1} AS (SELECT * REPLACE "
                f"(weight * (target_{d} / sum(weight) OVER (PARTITION BY {d})) AS weight) FROM fit{n})"
            )
            n += 1
    order = f"ORDER BY rate DESC, {dims}"
    before = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    steps += [
        f"rated AS (SELECT *, weight / share AS rate FROM fit{n})",
        f"scaled AS (SELECT *, ({float(mix.budget)!r} - coalesce(sum(share) OVER {before}, 0)) / "
        f"(sum(weight) OVER () - coalesce(sum(weight) OVER {before}, 0)) AS scale_here FROM rated)",
        "chosen AS (SELECT *, first_value(CASE WHEN scale_here * rate <= 1 THEN scale_here END "
        f"IGNORE NULLS) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) "
        "AS scale FROM scaled)",
        f"fitted AS (SELECT {dims}, least(1.0, coalesce(scale * rate, 1.0)) AS p FROM chosen)",
    ]
    digest = f"md5(concat(coalesce(CAST(doc_id AS VARCHAR), concat('none ', md5(text))), ':{mix.seed}'))"
    drawn = f"CAST(CAST(concat('0x', substr({digest}, 1, 13)) AS BIGINT) AS DOUBLE) / {float(16**13)!r}"
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, {dims}, tokens, round(p, 6) AS probability "
        f"FROM docs JOIN fitted USING ({dims}) WHERE tokens > 0 AND {drawn} < p"
    )
