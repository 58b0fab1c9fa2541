"""Mixing (1), ordinal classifier (2), secrets (4), shards (7), search (8), and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from latebird.llm import catalog, mixing, ordinal, secret_scan, sharding, topk


def rows_of(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_check_sql(spark, small_dir, duck_llm, name):
    ours = catalog.QUERIES[name](spark, small_dir)
    columns = sorted(ours.columns)
    sql = f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})"
    assert rows_of(ours, columns) == sorted(duck_llm.execute(sql).fetchall(), key=str)


# ---- Mixing


def test_raked_weights_meet_the_targets(spark):
    cells = [
        ("a", "x", "p", 700), ("a", "x", "q", 200), ("a", "y", "p", 40), ("a", "y", "q", 10),
        ("b", "x", "p", 10), ("b", "x", "q", 20), ("b", "y", "p", 15), ("b", "y", "q", 5),
    ]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    mix = mixing.Mix(weights={"lang": {"x": 0.6, "y": 0.4}}, budget=0.3)
    got = mixing.fit_cells(frame, mix).collect()
    share = {"a": 0.95**0.5, "b": 0.05**0.5}
    for value in "ab":
        total = sum(r["weight"] for r in got if r["source"] == value)
        assert total == pytest.approx(share[value] / sum(share.values()), abs=1e-3)
    assert sum(r["weight"] for r in got if r["lang"] == "y") == pytest.approx(0.4, abs=1e-3)
    assert sum(r["share"] * r["probability"] for r in got) == pytest.approx(0.3)
    assert max(r["probability"] for r in got) == 1.0


def test_raking_goes_on_until_the_targets_are_met(spark):
    cells = [("a", "x", 100_000), ("a", "y", 1), ("b", "x", 1), ("b", "y", 100_000)]
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    powers = {"source": 1.0, "lang": 1.0}
    weights = {"source": {"a": 0.53, "b": 0.47}, "lang": {"x": 0.5, "y": 0.5}}
    got = mixing.fit_cells(frame, mixing.Mix(powers=powers, weights=weights, most_rounds=1_000)).collect()
    for d, value, target in (("source", "a", 0.53), ("lang", "x", 0.5)):
        assert sum(r["weight"] for r in got if r[d] == value) == pytest.approx(target, rel=2e-9)


def test_targets_out_of_reach_are_reported(spark):
    cells = [("a", "x", 10), ("b", "y", 10)]  # tied: source and language cannot differ
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    weights = {"source": {"a": 0.7, "b": 0.3}, "lang": {"x": 0.4, "y": 0.6}}
    mix = mixing.Mix(powers={"source": 1.0, "lang": 1.0}, weights=weights, most_rounds=10)
    with pytest.warns(UserWarning, match="off by up to 1 after 10 rounds"):
        got = mixing.fit_cells(frame, mix).collect()
    assert sum(r["share"] * r["probability"] for r in got) == pytest.approx(0.5)


def test_a_weight_of_nothing_gives_nothing(spark):
    cells = [("a", "x", 10), ("a", "y", 30), ("b", "x", 20), ("b", "y", 40)]
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    mix = mixing.Mix(powers={"source": 1.0, "lang": 1.0}, weights={"lang": {"x": 0.0, "y": 1.0}}, budget=0.9)
    got = {(r["source"], r["lang"]): r["probability"] for r in mixing.fit_cells(frame, mix).collect()}
    assert got["a", "x"] == got["b", "x"] == 0.0 and got["a", "y"] == got["b", "y"] == 1.0


def test_mixing_edges(edge_docs, no_docs):
    kept = mixing.sample_mix(edge_docs, mixing.Mix(budget=1.0))
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == Counter(
        [None, 3, 3, 4, 5, 7]
    )
    assert kept.columns[: len(edge_docs.columns)] == edge_docs.columns
    assert mixing.sample_mix(no_docs).count() == 0


def test_mixing_has_no_python(spark, small_dir):
    plan = catalog.QUERIES["op1_raked_mix"](spark, small_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- Ordinal classifier


def test_ordinal_on_held_out_documents(make_docs, spark):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(1500):
        text = list(rng.choice(words, int(rng.integers(20, 80))))
        quality, toxic = int(rng.random() > 0.2), int(rng.random() < 0.2)
        if not quality:
            text = [w + "###" for w in text]
        if toxic:
            text[3] = str(rng.choice(["idiot", "scumlord", "scumbag"]))
        docs.append((i, " ".join(text)))
        if i < 1200:
            labels.append((i, quality, toxic))
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in ordinal.grade_documents(make_docs(*docs), frame).collect()}
    clean = bad = 0
    for i, text in docs[1200:]:
        rejected = "###" in text or "idiot" in text or "scum" in text
        clean += not rejected and got[i]["kept"]
        bad += rejected and got[i]["kept"]
        assert 0 <= got[i]["tail"] <= 1 and 0 <= got[i]["expected_grade"] <= 2
    n_bad = sum("###" in t or "idiot" in t or "scum" in t for _, t in docs[1200:])
    assert bad <= 0.03 * n_bad and clean >= 0.97 * (300 - n_bad)


def test_fit_is_that_of_all_features(make_docs, spark, monkeypatch):
    """16,000 documents are fitted; only features tied to the grade come to the driver."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"word{w}" for w in rng.integers(0, 300, 8))) for i in range(16_100)]
    grades = [(i, int(rng.integers(0, 3))) for i in range(16_100)]
    docs = [(i, f"{t} vile{i % 7}" if g == 1 and i % 40 < 7 else t) for (i, t), (_, g) in zip(docs, grades)]
    given, fit = [], ordinal.fit_ordinal
    monkeypatch.setattr(ordinal, "fit_ordinal", lambda *a: given.append(a) or fit(*a))
    frame = spark.createDataFrame(grades, "doc_id long, grade int")
    got = ordinal.fit_quality(make_docs(*docs), frame)
    features, counts, chosen, _ = given[0]
    assert len(chosen) == 16_000 and len(features) < 16_000
    by_hash = frame.orderBy(F.xxhash64("doc_id"), "doc_id").limit(16_000).collect()
    memory, texts = ordinal._Memory(), dict(docs)
    rows = [sorted(ordinal.text_features(texts[r[0]], memory)) for r in sorted(by_hash)]
    flat, sizes = np.concatenate(rows).astype(np.int32), np.array([len(r) for r in rows])
    want = fit(flat, sizes, np.array([r[1] for r in sorted(by_hash)]), 3)
    assert want.weights and got.weights == want.weights and got.cut == want.cut
    assert (got.thresholds == want.thresholds).all()


def test_copies_are_one_document_of_the_fit(make_docs, spark, monkeypatch):
    texts = [f"alpha{i} beta{i % 7} gamma" for i in range(40)]
    docs = [(i, texts[i % 40]) for i in range(4000)] + [(3, "a second text"), (None, texts[0])]
    grades = [(i, 0 if i == 45 else 2) for i in range(4000)]
    given = []
    monkeypatch.setattr(ordinal, "fit_ordinal", lambda *a: given.append(a))
    frame = spark.createDataFrame(grades, "doc_id long, grade int")
    for rows in (docs, docs[::-1]):
        ordinal.fit_quality(make_docs(*rows), frame)
    chosen = [sorted(g[2].tolist()) for g in given]
    # Texts by smallest doc_id; doc_id 3 may have either text, the same in both runs.
    assert chosen[0] == chosen[1] and len(chosen[0]) in (40, 41) and chosen[0].count(0) == 1


def test_thresholds_are_ordered():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(300)]
    counts = np.array([len(r) for r in rows])
    model = ordinal.fit_ordinal(np.concatenate(rows), counts, rng.integers(0, 4, 300), 4)
    assert (np.diff(model.thresholds) > 0).all()


def test_slopes_match_differences():
    scores, grades, cuts = np.array([0.3, -1.0, 2.0]), np.array([0, 1, 2]), np.array([-0.5, 0.7])

    def loss(s):
        ends = np.concatenate(([-np.inf], cuts, [np.inf]))
        sigmoid = lambda x: 1 / (1 + np.exp(-x))
        return -np.log(sigmoid(ends[grades + 1] - s) - sigmoid(ends[grades] - s))

    slope, bend = ordinal._slopes(scores, grades, cuts)
    step = 1e-4
    assert np.allclose(slope, (loss(scores + step) - loss(scores - step)) / (2 * step), atol=1e-5)
    curve = (loss(scores + step) - 2 * loss(scores) + loss(scores - step)) / step**2
    assert np.allclose(bend, curve, atol=1e-3)


def test_ordinal_edges(edge_docs, no_docs, labels, no_labels):
    got = ordinal.grade_documents(edge_docs, no_labels).collect()
    assert len(got) == edge_docs.count()
    assert not any(r["kept"] for r in got if r["doc_id"] in (1, 2, 6))
    assert all(r["kept"] for r in got if r["doc_id"] in (3, 4, 5))
    assert ordinal.grade_documents(no_docs, labels).count() == 0
    assert ordinal.select_documents(edge_docs, no_labels).columns == edge_docs.columns


# ---- Secrets

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def test_secrets_query_finds_assigned_values(spark, small_dir, rows):
    import re

    planted = {(r[0], s) for r in rows for s in re.findall(r'(?i)token = "([^"]+)"', r[1] or "")}
    got = catalog.QUERIES["op4_forest_secrets"](spark, small_dir).collect()
    assert {(r["doc_id"], r["candidate"]) for r in got if r["is_secret"]} >= planted
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert texts[r["doc_id"]].index(r["candidate"]) + 1 == r["start"]


def test_false_positives_go(make_docs):
    docs = make_docs(
        *[(i, f'here token = "{i:02x}{HEX[2:]}" and 4111111111111{i:03d} or more') for i in range(60)],
        (100, "see /usr/share/doc/package-2023/readme1.txt for it"),
    )
    got = {(r["doc_id"], r["candidate"]): r["is_secret"] for r in secret_scan.scan_secrets(docs).collect()}
    assert all(v == (k[1].endswith(HEX[2:])) for k, v in got.items())
    assert sum(got.values()) == 60


def test_assigned_values_are_whole(make_docs):
    """Any sign may stand in a value; quotes, white space and end marks bound it."""
    given = {
        'password = "hunter2x$Kq9vTz" and more': {"hunter2x$Kq9vTz"},
        'db_password="abc12%Xy99887"': {"abc12%Xy99887"},
        "password: P@ss#word1!": {"P@ss#word1!"},
        "the password: a1,b2;c3|d4&e5*f6.": {"a1,b2;c3|d4&e5*f6"},
        'secret = "two words, 1 value" next': {"two words, 1 value"},
        r'secret = "in\"side1 x" next': {r'in\"side1 x'},
        "pwd='it \"is\" 7' next": {'it "is" 7'},
        "api_key='k9#unclosed1 and so on": {"k9#unclosed1"},
        'token="abc": token="open one\npassword="hunter2 x y"': {"hunter2 x y", "open one\npassword="},
        "see x?token=ab12cd34&user=me for": {"ab12cd34&user=me", "ab12cd34"},
        '{"token":"abc12$def","user":"me"}': {"abc12$def"},
    }
    docs = make_docs(*enumerate(given))
    got = defaultdict(set)
    for r in secret_scan.candidates(docs).collect():
        got[r["doc_id"]].add(r["candidate"])
    for i, (text, whole) in enumerate(given.items()):
        assert got[i] >= whole, text
        assert all(any(w in g or g in w for w in whole) for g in got[i]) or "open" in text, text
    exact = [i for i, t in enumerate(given) if "open" not in t]
    assert {i: got[i] for i in exact} == {i: list(given.values())[i] for i in exact}


def test_every_place_of_a_candidate_counts(make_docs):
    """A value that stands in a path, bare or within a word first, and is assigned later."""
    value = lambda i: f"{i:03d}{HEX[3:]}"
    docs = [(i, f'a token = "{value(i)}" here, 4111111111111{i:03d} there') for i in range(60)]
    docs += [
        (100, f'see /tmp/{value(100)} or more, then token = "{value(100)}" in use'),
        (101, f'{value(101)} first; {value(101)} again, token = "{value(101)}"'),
        (102, "see hunter2x$K77qv or xhunter2x$K77qv, then password = hunter2x$K77qv"),
    ]
    got = secret_scan.scan_secrets(make_docs(*docs, docs[-1])).collect()
    assert {r["doc_id"] for r in got if r["is_secret"]} == {*range(60), 100, 101, 102}
    whole = [r for r in got if r["candidate"] in (value(100), value(101), "hunter2x$K77qv")]
    assert sorted((r["doc_id"], r["start"]) for r in whole) == [(100, 10), (101, 1), (102, 5), (102, 5)]
    assert all(r["is_secret"] for r in whole)


def test_places_match_python(make_docs):
    import re

    text = f"\u00e9\U0001f600 {HEX}: {HEX[:20]} x" * 3 + "token='q:w:e:r' " * 2
    places = secret_scan.candidates(make_docs((1, text))).collect()
    found = lambda s: [m.start() for m in re.finditer(re.escape(s), text)]
    around = lambda i, n: (text[max(0, i - 60) : i], text[i + n : i + n + 60])
    want = {(HEX, *around(i, 40)) for i in found(HEX)}
    want |= {(HEX[:20], *around(i, 20)) for i in found(HEX[:20] + " ")}
    want |= {("q:w:e:r", text[i - 60 : i], text[i + 7 : i + 67]) for i in found("q:w:e:r")}
    assert {(r["candidate"], r["before"], r["after"]) for r in places} == want
    assert all(r["start"] == text.index(r["candidate"]) + 1 for r in places)


def test_long_texts_of_assignments_end(make_docs):
    docs = make_docs((1, "token=" * 60_000), (2, "token='" * 3_000), (3, 'token="' + "\\a" * 300_000))
    assert secret_scan.candidates(docs).count() >= 2


PROSE = "the password: 'tis said of old, in 1850, that the keepers of the gate asked each traveller until they don't"


def test_prose_is_no_secret(make_docs):
    """Quotes end with their line, and an apostrophe between letters is none."""
    known = [(i, f'token = "{i:02x}{HEX[2:]}" and 4111111111111{i:03d}') for i in range(60)]
    prose = [
        (100, PROSE),
        (101, "the secret: 'tis 1850 out there\n" + "and so the tale goes on, in 1851 too\n" * 20 + "the end' he said"),
        (102, 'he said "token": "a thing of old, said the keeper\nin 1850 to 1852" and left'),
    ]
    docs = make_docs(*known, *prose)
    got = secret_scan.scan_secrets(docs).collect()
    assert {r["doc_id"] for r in got if r["is_secret"]} == set(range(60))
    assert all(len(r["candidate"]) < 30 for r in got if r["doc_id"] >= 100)
    out = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(docs).where("doc_id >= 100").collect()}
    assert out == dict(prose)


def test_aligned_and_quoted_values_are_whole(make_docs):
    values = {
        1: ("password              = hunter2x$K77qv", "hunter2x$K77qv"),
        2: ("api_key\t\t:\t\t\t\t\tab12$cd34", "ab12$cd34"),
        3: ("secret:\n      q1w2e3r4t5", "q1w2e3r4t5"),
        4: ("pwd = 'it's1a2b3c4d' rest", "it's1a2b3c4d"),
        5: ("token = '12ab34cd'x more", "12ab34cd'x"),
        6: ('auth = "a\\"b1c2d3" rest', 'a\\"b1c2d3'),
        7: ("TOKEN='x1y2z3w4", "x1y2z3w4"),
    }
    got = secret_scan.candidates(make_docs(*[(i, t) for i, (t, _) in values.items()])).collect()
    found = {i: {r["candidate"] for r in got if r["doc_id"] == i} for i in values}
    assert {i for i, (_, want) in values.items() if want not in found[i]} == set(), found


def test_anchors_stand_in_for_a_missing_kind(make_docs):
    docs = make_docs(*[(i, f"key {HEX[:16]}{i:04d} and {i:04d}ABCDEFGHIJKLMNOP9") for i in range(20)])
    rows = secret_scan.featured(docs, secret_scan.candidates(docs))
    kinds = {}
    for name, label in (("both", F.col("candidate").contains("ABC").cast("double")), ("one", F.lit(0.0))):
        fitted = secret_scan.fit_forest(rows, label)
        kinds[name] = fitted.stages[1].numClasses
    assert kinds == {"both": 2, "one": 2}


def test_findings_train_the_forest(spark, make_docs):
    docs = make_docs(*[(i, f"id {HEX[:16]}{i:04d} word, key {i:04d}ABCDEFGHIJKLMNOP9 end") for i in range(40)])
    labels = [(i, f"{HEX[:16]}{i:04d}", 0.0) for i in range(30)]
    labels += [(i, f"{i:04d}ABCDEFGHIJKLMNOP9", 1.0) for i in range(30)]
    findings = spark.createDataFrame(labels, "doc_id long, candidate string, label double")
    for r in secret_scan.scan_secrets(docs, findings).collect():
        assert r["is_secret"] == ("ABC" in r["candidate"])


def test_redaction(edge_docs, no_docs):
    out = secret_scan.redact_secrets(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    changed = out.where("doc_id = 7").first()
    assert HEX not in changed["text"] and secret_scan.PLACEHOLDER in changed["text"]
    assert changed["n_chars"] == len(changed["text"])
    same = lambda frame: Counter(
        (r["doc_id"], r["text"]) for r in frame.where("doc_id IS NULL OR doc_id <> 7").collect()
    )
    assert same(out) == same(edge_docs)
    assert secret_scan.redact_secrets(no_docs).count() == 0


def test_secrets_within_and_across_secrets(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "text string, s array<string>")
    given = {
        ("x aa.zz12345 y", ("zz12345", "aa.zz12345")): "x [S] y",
        ("password=ab12cd.tail9 y", ("password=ab12cd", "ab12cd.tail9")): "[S] y",
        ("ab12ab12ab12 then ab12ab12", ("ab12ab12",)): "[S] then [S]",
        ("S is [S] \\E (a|b)$ \\Q", ("S", r"\E (a|b)$")): "[S] is [[S]] [S] \\Q",
        ("\U0001f600k1k1\U0001f600", ("k1",)): "\U0001f600[S][S]\U0001f600",
        ("none", ("k1",)): "none",
    }
    rows = frame(*[(t, list(s)) for t, s in given]).select("text", secret_scan._without(F.col("s"), "[S]"))
    assert [r[1] for r in rows.collect()] == list(given.values())


def test_redaction_leaves_no_part(make_docs):
    tail = lambda i: f"zz1{i:03d}5678901234567"
    docs = make_docs(*[(i, f"password=aa.{tail(i)} and 4111111111111{i:03d}") for i in range(60)])
    for r in secret_scan.redact_secrets(docs).collect():
        assert "aa." not in r["text"] and "zz1" not in r["text"]


def test_rows_without_doc_id_are_redacted(make_docs):
    docs = [(None if i % 3 else 1, f'token = "{i:02x}{HEX[2:]}", 4111111111111{i:03d}') for i in range(60)]
    plain = (None, "nothing of the kind")
    out = secret_scan.redact_secrets(make_docs(*docs, docs[1], plain, (None, None))).collect()
    assert len(out) == 63 and not any(HEX[2:] in (r["text"] or "") for r in out)
    assert sum(secret_scan.PLACEHOLDER in (r["text"] or "") for r in out) == 61
    assert {plain[1], None} <= {r["text"] for r in out}


def test_secret_plan_has_no_python(edge_docs):
    plan = secret_scan.redact_secrets(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


# ---- Shards


def check_shards(got, texts, shards):
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        assert 0 <= r["shard"] < shards
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_shards_query(spark, small_dir, rows):
    got = catalog.QUERIES["op7_kd_shards"](spark, small_dir).collect()
    assert len(got) == len(rows)
    check_shards(got, {r[0]: r[1] for r in rows}, 24)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}


def test_shards_are_even_and_copies_stay_together(make_docs):
    rng = np.random.default_rng(3)
    docs = [(i, f"{i} " + "x" * int(rng.integers(0, 400)), "en", f"s{i % 7}", None) for i in range(4000)]
    docs += [(5000 + i, "the same text", "en", f"s{i % 7}", None) for i in range(20)]
    docs += [(6000 + i, "a hot text", "de", "s0", None) for i in range(3000)]
    got = sharding.assign_shards(make_docs(*docs), 24).collect()
    texts = {d[0]: d[1] for d in docs}
    sizes = check_shards(got, texts, 24)
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    assert len({r["shard"] for r in got if 5000 <= r["doc_id"] < 6000}) == 1


def test_splits_are_weighted_quantiles(spark):
    """One dimension that varies: shards are stretches of it, cut at the median."""
    docs = [(i, "y" * (i + 1), "en", "s", None) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n long")
    got = sharding.assign_shards(frame, 2).collect()
    left = {r["doc_id"] for r in got if r["shard"] == 0}
    assert left == set(range(len(left))) or left == set(range(200 - len(left), 200))
    assert abs(sum(r["size"] for r in got if r["shard"] == 0) - sum(r["size"] for r in got) / 2) <= 208


def test_sharding_edges(edge_docs, no_docs):
    got = sharding.assign_shards(edge_docs, 4).collect()
    assert len(got) == edge_docs.count()
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {8}
    assert sharding.assign_shards(no_docs, 4).count() == 0


# ---- Search


def brute_top(rows, k):
    out = []
    usable = [
        (i, np.floor(256 * np.asarray(v, float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    for place, (i, q) in enumerate(usable):
        if i % 50 == 0:
            n = lambda v: min(len(q), len(v))
            scored = [(-int(q[: n(v)] @ v[: n(v)]), j) for p, (j, v) in enumerate(usable) if p != place]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def search(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, topk.exact_top_k(frame, F.col("vec_id") % 50 == 0, k).collect()))


def test_search_matches_brute_force(spark, monkeypatch):
    for name, value in (("CHUNK", 3), ("SLAB", 60), ("HEAD", 16), ("STEP", 20)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(400, 12)) * rng.lognormal(size=(400, 1)) * np.linspace(2, 0.1, 12)
    vectors[200:260] = vectors[:60]  # ties
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(vectors)]
    assert search(spark, rows) == brute_top([r[:2] for r in rows], 5)


def test_rows_are_sent_where_they_are_long_enough(spark, monkeypatch):
    for name, value in (("CHUNK", 4), ("SLAB", 50), ("HEAD", 32)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(1000, 8)) * rng.lognormal(sigma=1.5, size=(1000, 1))
    vectors[700:] /= np.sqrt((vectors[700:] ** 2).sum(axis=1, keepdims=True))  # one band of many
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(vectors)]
    sent = []
    plain = topk.blocks

    def counted(asked, given):
        pair = plain(asked, given)
        norms = [r["norm"] for r in given.select("norm").collect()]
        needs = [r["need"] for r in asked.select("need").collect()]
        sent.append((pair[1].count(), pair[1].select("chunk").distinct().count(), len(norms)))
        met = pair[0].select("row", "chunk", "slab", "need")
        together = met.join(pair[1].select(F.col("row").alias("other"), "chunk", "slab", "norm"), ["chunk", "slab"])
        pairs = together.where("norm >= need")
        assert pairs.count() == pairs.distinct().count() == sum(c >= n for n in needs for c in norms)
        return pair

    monkeypatch.setattr(topk, "blocks", counted)
    assert search(spark, rows) == brute_top([r[:2] for r in rows], 5)
    rows_sent, chunks, n = sent[0]
    assert chunks > 1 and rows_sent < 0.5 * chunks * n


def test_search_ends_on_too_wide_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0] * 9)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="9 components"):
        topk.exact_top_k(frame, F.col("vec_id") % 50 == 0, most_width=8)


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], None), (1, [nan, 1.0], 1), (2, [inf, 0.0], 1), (3, None, 1), (4, [None, 1.0], 1),
        (5, [1.0], 1), (6, [], 1), (50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (7, [-1.0, -1.0], 1),
        (None, [9.0, 9.0], 1),
    ]
    assert search(spark, rows) == brute_top([r[:2] for r in rows], 5)
    assert search(spark, rows[:1]) == []
    short = [(0, [], 1), (50, [], 1), (3, [], 1)]
    assert search(spark, short) == brute_top([r[:2] for r in short], 5)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_scores_beyond_floats(spark):
    rows = [(0, [3e5, 1.0], 0), (1, [3e5, 2.0], 0), (2, [3e5, 3.0], 0)]
    assert search(spark, rows) == brute_top([r[:2] for r in rows], 5)


# ---- Pipeline


def test_pipeline(spark, small_dir, documents):
    import corpus_pipeline
    from latebird.llm.common import staged

    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, before, small_dir), f"test-{name}")
        if name != "pack":
            assert docs.columns == documents.columns, name
            lost = docs.select("doc_id").subtract(before.select("doc_id")).count()
            assert lost == 0 and 0 < docs.count() <= before.count(), name
    assert docs.select("doc_id").distinct().count() == before.count()
    assert sum(r["length"] for r in docs.select("length").collect()) > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mix", "pack"]


def test_pipeline_stages_stand_edges(spark, edge_docs, no_docs, small_dir):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge_docs, small_dir).count() >= 0, name
        assert stage(spark, no_docs, small_dir).count() == 0, name


def test_short_values_go_on_behind_a_line_break(make_docs):
    given = {
        'token="open one\npassword="hunter2 x y"': {"open one\npassword="},
        "pwd='ab12\r\ncd34' x": {"ab12\r\ncd34"},
        'token="said the keeper of 1850\nand left"': set(),
        'token="a1b2c3\nd4\ne5f6"': set(),
    }
    got = defaultdict(set)
    for r in secret_scan.candidates(make_docs(*enumerate(given))).collect():
        got[r["doc_id"]].add(r["candidate"])
    assert {i: {c for c in got[i] if "\n" in c} for i in range(len(given))} == dict(enumerate(given.values()))
