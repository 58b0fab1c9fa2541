"""Licence scan by a positional index of rare template words.

Templates are licence notices and texts as rows of words. One pass over all
documents counts in how many each template word occurs; that gives its inverse
document frequency (IDF). A second pass then handles every document by itself:

1. Of each template whose key-phrase words the document has, look up the
   document's `RARE` words of highest IDF.
2. Each place of such a word votes, by the template's postings, for the place at
   which the template would begin there. Votes within `SLACK` words agree, so a
   few words put in or left out do no harm.
3. Where at least half of the rare words agree, the template's key phrases must
   stand within the window, consecutively, and the window's words must hold at
   least `LEAST` of the template's IDF weight. That share is the score.

A template that stands in a text word by word is always found, however many
others stand there: its rare words are looked up for it alone. Besides, the
places of plain base phrases are reported.

All of it is SQL functions over one row; nothing but the word counts is
shuffled. The driver gets one count for each template word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import text_or_empty

#: What parts words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Places of base phrases.
PLACES = "array<struct<word:int,label:string>>"
RARE = 8
SLACK = 16
LEAST = 0.6


@dataclass(frozen=True)
class Template:
    """A licence notice or text: lower-case words with blanks between, and the
    phrases without which it isn't this licence."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Short notices, and characteristic parts of licence texts.
TEMPLATES = (
    Template("mit", "under the mit license", ("mit license",)),
    Template("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template("apache-2.0", "under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("apache-2.0", "spdx license identifier apache 2 0", ("spdx license identifier apache 2 0",)),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("apache license", "except in compliance with the license"),
    ),
    Template("gpl-2.0", "gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "gnu general public license version 3", ("general public license", "version 3")),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        ("redistribute it and or modify it", "gnu general public license"),
    ),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license",)),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
        "mpl was not distributed with this file you can obtain one at",
        ("source code form is subject to the terms", "mozilla public license"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met redistributions of source code must retain the above "
        "copyright notice this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all "
        "copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the "
        "authors be held liable for any damages arising from the use of this software permission is granted "
        "to anyone to use this software for any purpose including commercial applications",
        ("in no event will the authors be held liable", "permission is granted to anyone"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template(
        "cc-by",
        "licensed under the creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-nc",
        "licensed under the creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for a row."""
    return F.transform(F.array(value), body)[0]


def text_words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased and all else as it is."""
    plain = F.octet_length(text) == F.length(text)  # then lower() touches nothing but A-Z
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _vocabulary(templates: Sequence[Template], base: Mapping[str, str]) -> list[str]:
    words = {w for t in templates for w in t.words}
    words |= {w for t in templates for p in t.phrases for w in p.split()}
    return sorted(words | {w for p in base for w in p.split()})


def word_weights(docs: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, float]:
    """The IDF of each vocabulary word over all rows of `docs`: ln(1 + rows / (1 + rows with it))."""
    own = F.array_intersect(F.lit(list(vocabulary)), text_words(text_or_empty(text)))
    # The empty word stands for the row itself.
    counted = docs.select(F.explode(F.array_append(own, "")).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}  # at most one row for a vocabulary word
    rows = counts.get("", 0)
    return {w: math.log1p(rows / (1 + counts.get(w, 0))) or 1.0 for w in vocabulary}


def _index(templates: Sequence[Template], weights: Mapping[str, float]) -> Column:
    """The templates with their words by falling IDF, and postings of each word."""
    made = []
    for number, t in enumerate(templates):
        places: dict[str, list[int]] = {}
        for place, word in enumerate(t.words):
            places.setdefault(word, []).append(place)
        ranked = sorted(places, key=lambda w: (-weights[w], w))
        total = sum(weights[w] for w in ranked)
        made.append(
            F.struct(
                F.lit(number).alias("number"),
                F.lit(t.label).alias("label"),
                F.lit(len(t.words)).alias("length"),
                F.lit(ranked).alias("ranked"),
                F.lit([weights[w] / total for w in ranked]).alias("shares"),
                F.array(*[F.lit(places[w]) for w in ranked]).alias("postings"),
                F.lit(sorted({w for p in t.phrases for w in p.split()})).alias("phrase_words"),
                F.lit([f" {p} " for p in t.phrases]).alias("phrases"),
            )
        )
    return F.array(*made)


def _phrase_places(words: Column, present: Column, phrase: str, label: str) -> Column:
    """(word, label) of each place where the phrase's words stand consecutively."""
    parts = phrase.split()
    none = F.array().cast(PLACES)

    def stands(i: Column) -> Column:
        here = F.lit(True)
        for k, part in enumerate(parts):
            here = here & (F.get(words, i + k) == part)
        return here

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)
    found = F.transform(starts, lambda i: F.struct(i.alias("word"), F.lit(label).alias("label")))
    has_words = F.size(F.array_except(F.lit(parts), present)) == 0
    return F.when(has_words, found).otherwise(none)


def _windows(words: Column, present: Column, t: Column, rare: int, slack: int) -> Column:
    """(window, agreeing) of the stretches of 2 * `slack` possible beginnings of the
    template, and how many of its rare places agree on one."""
    chosen = F.slice(F.array_intersect(t.ranked, present), 1, rare)
    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(chosen, F.get(words, i)))

    def votes(i: Column) -> Column:
        posted = F.get(t.postings, (F.array_position(t.ranked, F.get(words, i)) - 1).cast("int"))

        def vote(p: Column) -> Column:
            window = F.floor((i - p) / slack).cast("int")
            return F.array(
                F.struct((window - 1).alias("window"), p.alias("place")),
                F.struct(window.alias("window"), p.alias("place")),
            )

        return F.flatten(F.transform(posted, vote))

    def counted(v: Column) -> Column:
        """How many distinct places of the sorted votes fall into each window."""
        first = F.filter(
            F.sequence(F.lit(0), F.size(v) - 1),
            lambda j: (j == 0) | (F.get(v, j).window != F.get(v, j - 1).window),
        )
        return _let(
            first,
            lambda f: F.transform(
                f,
                lambda j, k: F.struct(
                    F.get(v, j).window.alias("window"),
                    (F.coalesce(F.get(f, k + 1), F.size(v)) - j).alias("agreeing"),
                ),
            ),
        )

    sorted_votes = F.array_sort(F.array_distinct(F.flatten(F.transform(at, votes))))
    none = F.array().cast("array<struct<window:int,agreeing:int>>")
    needed = F.ceil(F.least(F.size(t.ranked), F.lit(rare)) / 2)
    counts = _let(sorted_votes, lambda v: F.when(F.size(v) > 0, counted(v)).otherwise(none))
    return F.filter(counts, lambda c: c.agreeing >= needed)


def _verified(words: Column, windows: Column, t: Column, slack: int, least: float) -> Column:
    """(template, label, word, score) of the windows that hold the key phrases and
    enough of the template's weight."""

    def judged(c: Column) -> Column:
        start = F.greatest(c.window * slack, F.lit(0))
        own = F.slice(words, start + 1, t.length + 3 * slack)

        def judge(w: Column) -> Column:
            text = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
            share = F.aggregate(
                F.transform(
                    t.ranked, lambda x, i: F.when(F.array_contains(w, x), F.get(t.shares, i)).otherwise(0.0)
                ),
                F.lit(0.0),
                lambda a, b: a + b,
            )
            phrases = _let(text, lambda x: F.forall(t.phrases, lambda p: F.contains(x, p)))
            return F.struct(
                t.number.alias("template"),
                t.label.alias("label"),
                start.alias("word"),
                F.when(phrases, F.least(share, F.lit(1.0))).otherwise(0.0).alias("score"),
                c.agreeing.alias("agreeing"),
            )

        return _let(own, judge)

    good = F.filter(F.transform(windows, judged), lambda x: x.score >= least)

    # Windows overlap, so a place stands in two of them: the one with more agreement is kept.
    def best(g: Column, x: Column, i: Column) -> Column:
        before, after = F.get(g, i - 1), F.get(g, i + 1)
        beaten = (x.word - before.word <= slack) & (before.agreeing >= x.agreeing)
        beaten_later = (after.word - x.word <= slack) & (after.agreeing > x.agreeing)
        return ~F.coalesce(beaten, F.lit(False)) & ~F.coalesce(beaten_later, F.lit(False))

    return _let(good, lambda g: F.filter(g, lambda x, i: best(g, x, i)))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    base: Mapping[str, str] = BASE_PHRASES,
    rare: int = RARE,
    slack: int = SLACK,
    least: float = LEAST,
) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, `base` (word, label) with
    every place of a base phrase, words numbered from 0, and `found` (template, label,
    word, score, agreeing): templates verified, with the first word of the stretch of
    2 * `slack` words in which each begins, its score from `least` to 1, and how many
    rare places agree. Places of a template that follow closer are reported as one.

    Null and empty texts have no words and find nothing. A null doc_id stays null;
    repeated rows are handled each for itself, and count each in the IDF; other
    columns are left out; an empty table gives an empty result. Texts are taken
    whole; the work on one grows with its length. Words of equal IDF are taken in
    word order.
    """
    vocabulary = _vocabulary(templates, base)
    weights = word_weights(docs, vocabulary)
    index = _index(templates, weights)
    key_words = [{w for p in t.phrases for w in p.split()} for t in templates]
    rarest = F.lit(sorted({max(own, key=lambda w: (weights[w], w)) for own in key_words}))
    vocabulary_column = F.lit(vocabulary)

    def scan(words: Column) -> Column:
        def with_present(present: Column) -> Column:
            none_placed = F.array().cast(PLACES)
            places = [_phrase_places(words, present, p, label) for p, label in base.items()]
            none = F.filter(index, lambda t: F.lit(False))
            hinted = F.filter(index, lambda t: F.size(F.array_except(t.phrase_words, present)) == 0)
            # Most texts have no template's rarest key word.
            possible = F.when(F.arrays_overlap(present, rarest), hinted).otherwise(none)

            def found(t: Column) -> Column:
                windows = _windows(words, present, t, rare, slack)
                return _verified(words, windows, t, slack, least)

            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.array_sort(F.concat(none_placed, *places)).alias("base"),
                F.flatten(F.transform(possible, found)).alias("found"),
            )

        return _let(F.array_intersect(vocabulary_column, words), with_present)

    result = _let(text_words(text_or_empty()), scan)
    scanned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), result.alias("scan"))
    return scanned.select("doc_id", "scan.n_words", "scan.base", "scan.found")
