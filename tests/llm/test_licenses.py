"""Licence scan: base places against brute force, templates planted in prose."""

import random
import re

import pytest

from latebird.llm.catalog import QUERIES
from latebird.llm.license_scan import BASE_PHRASES, TEMPLATES, Template, scan_licenses, word_weights

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(places)


def brute_labels(text):
    """Labels of the templates that stand in the text word by word."""
    joined = " " + " ".join(WORD.findall((text or "").translate(LOWER))) + " "
    return {t.label for t in TEMPLATES if f" {t.text} " in joined}


def prose(rng, n):
    common = "the of and to a in is for this with or any copy file under use software public river stone".split()
    return [rng.choice(common) for _ in range(n)]


def test_query_equals_brute_force(spark, small_dir, rows):
    found = {r["doc_id"]: r for r in QUERIES["op11_rare_token_licenses"](spark, small_dir).collect()}
    assert len(found) == len(rows)
    labelled = 0
    for doc_id, text, *_ in rows:
        n, places = brute_base(text)
        r = found[doc_id]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        starts = [p for p, _ in places]
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        base = {label for _, label in places}
        assert r["base_labels"] == ",".join(sorted(base))
        labels = set(filter(None, r["labels"].split(",")))
        assert base | brute_labels(text) <= labels
        assert 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(labels - base or brute_labels(text))
        labelled += bool(labels)
    assert labelled


def test_whole_templates_are_found(spark, make_docs):
    rng = random.Random(3)
    texts = []
    for i, t in enumerate(TEMPLATES):
        body = t.text.upper() if i % 2 else ", ".join(t.words)
        texts.append(" ".join(prose(rng, 150)) + "\n" + body + ".\n" + " ".join(prose(rng, 150)))
    texts.append("\n\n".join(t.text for t in TEMPLATES))  # all in one file
    found = scan_licenses(make_docs(*enumerate(texts))).collect()
    for r in found[:-1]:
        own = [x for x in r["found"] if x["template"] == r["doc_id"]]
        assert own, TEMPLATES[r["doc_id"]]
        assert max(x["score"] for x in own) == pytest.approx(1)
        assert any(118 <= x["word"] <= 150 for x in own)
    assert {x["template"] for x in found[-1]["found"]} == set(range(len(TEMPLATES)))


def test_changed_and_missing_words(spark, make_docs):
    mit = next(t for t in TEMPLATES if t.label == "mit" and len(t.words) > 20)
    words = mit.words
    inserted = words[:12] + ["hello", "there"] + words[12:30] + ["again"] + words[30:]
    fewer = words[:32] + words[38:]
    no_phrase = [w for w in words if w != "hereby"]
    shuffled = sorted(words)
    docs = make_docs(*enumerate(" ".join(x) for x in (inserted, fewer, no_phrase, shuffled)))
    by_id = {r["doc_id"]: {x["label"] for x in r["found"]} for r in scan_licenses(docs).collect()}
    assert by_id == {0: {"mit"}, 1: {"mit"}, 2: set(), 3: set()}


def test_one_template_however_often(spark, make_docs):
    notice = "Licensed under the Apache License, Version 2.0. "
    far = " ".join(prose(random.Random(1), 200))
    docs = make_docs((1, notice * 400), (2, notice + far + notice + far), (3, "license " * 5_000))
    rows = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    assert len(rows[1]["base"]) == 400
    assert len([x for x in rows[2]["found"] if x["label"] == "apache-2.0" and x["score"] > 0.99]) >= 2
    assert rows[3]["found"] == [] and rows[3]["n_words"] == 5_000


def test_weights_count_all_rows(spark, make_docs):
    docs = make_docs((1, "alpha beta"), (1, "Alpha ALPHA"), (None, "alpha,gamma"), (2, None))
    weights = word_weights(docs, ["alpha", "beta", "gamma", "delta"])
    assert weights["alpha"] < weights["beta"] == weights["gamma"] < weights["delta"]


def test_own_templates_and_signs(spark, make_docs):
    house = Template("house", "straße rules apply to été files", ("été files",))
    docs = make_docs((1, "The STRAßE rules: apply to été files!"), (2, "ÉTÉ files of STRASSE"))
    found = {r["doc_id"]: r for r in scan_licenses(docs, [house], {}).collect()}
    assert [x["label"] for x in found[1]["found"]] == ["house"]
    assert found[2]["found"] == [] and found[2]["n_words"] == 4  # only A-Z is lower-cased


def test_edges(spark, edge_docs, no_docs):
    found = scan_licenses(edge_docs).collect()
    assert len(found) == edge_docs.count()
    empty = [r for r in found if r["doc_id"] in (1, 2, 6)]
    assert all((r["n_words"], r["base"], r["found"]) == (0, [], []) for r in empty)
    assert next(r for r in found if r["doc_id"] == 5)["n_words"] == 240_000
    assert scan_licenses(no_docs).collect() == []


def test_plan_is_native(spark, small_dir):
    plan = QUERIES["op11_rare_token_licenses"](spark, small_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
