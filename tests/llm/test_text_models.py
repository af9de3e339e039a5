"""Toxicity, language ID, licence scans and URL filters: accuracy, defined results, brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuswash.llm import langid, licenses, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, score string, h string"


def _text(r, syllables, n):
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


# ---- toxicity -----------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    r = random.Random(2)
    syllables = "th er on an in re nd at en es or ti st ar te ed is it al ha".split()
    bad = ["wumpus", "grobblig", "zarkon", "fnordly"]
    rows, labels = [], []
    for i in range(900):
        words = _text(r, syllables, r.randint(40, 150)).split()
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), "en", "s", "clash", "clash"))
        labels.append((i, 1, int(toxic)))
    extra = [(900, None, None, None, "", ""), (901, "", None, None, "", ""), (None, "wumpus", None, None, "", ""), (902, "Wumpus! " + "the " * 40_000, "en", "s", "", "")]
    return spark.createDataFrame(rows + extra, DOCS), spark.createDataFrame(labels + [(901, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), {i: t for i, _, t in labels}


def test_toxicity_on_held_out_rows(toxic_corpus):
    docs, labels, truth = toxic_corpus
    got = toxicity.report(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    told = [r for r in held if r["predicted"]]
    assert len(held) > 100
    assert sum(truth[r["doc_id"]] for r in told) >= 0.95 * len(told)
    assert sum(truth[r["doc_id"]] for r in told) >= 0.95 * sum(truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[900]["score"] == by[901]["score"] < 0.3 and by[902]["predicted"] == 1 and by[None]["held_out"] is False


def test_toxicity_rejects_and_keeps_columns(toxic_corpus):
    docs, labels, truth = toxic_corpus
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {i for i, t in truth.items() if not t} - left == set()
    assert {900, 901} <= left and 902 not in left


def test_toxicity_without_labels_or_rows(spark, toxic_corpus):
    docs, labels, _ = toxic_corpus
    few = docs.where("doc_id < 3")
    assert {r["score"] for r in toxicity.report(few, labels.where("false")).collect()} == {0.0}
    assert {r["score"] for r in toxicity.report(few, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.report(docs.where("false"), labels).count() == 0


def test_windows_cover_every_word():
    text = "One, two: three-four FÜNF 6 " * 50
    assert b" ".join(toxicity.windows(text)) == b" ".join(toxicity.windows(text, 7)) == b" ".join(toxicity.words_of(text))


# ---- language ID --------------------------------------------------------------

SYLLABLES = {"aa": "ka lo mi nu ra".split(), "bb": "sch ber ung der ich".split(), "cc": "tion eau oux ment ville".split()}


def test_language_of_held_out_rows(spark):
    r = random.Random(4)
    rows = [(i, _text(r, SYLLABLES[x], r.randint(5, 60)), x, "s", "", "") for i in range(400) for x in [r.choice(list(SYLLABLES))]]
    rows += [(400, None, "aa", "s", "", ""), (401, "123 !?", "aa", "s", "", ""), (402, "", None, None, "", ""), (403, rows[0][1], None, None, "", ""), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.report(docs).collect()
    assert len(got) == len(rows)
    truth = {i: x for i, _, x, *_ in rows[:400]}
    held = [x for x in got if x["held_out"] and x["doc_id"] in truth]
    assert sum(x["lang_pred"] == truth[x["doc_id"]] for x in held) >= 0.98 * len(held)
    by = {x["doc_id"]: x for x in got}
    assert {by[i]["lang_pred"] for i in (400, 401, 402)} == {"und"}
    assert by[403]["lang_pred"] == by[0]["lang_pred"]
    assert all(0 <= x["score"] <= 1 for x in got)


def test_counts_and_scores_equal_plain_loops(spark):
    texts = ["Ab c", "", "ß", "long " * 3000]
    points, at = langid.code_points(texts)
    model_docs = spark.createDataFrame([(0, "ab ab", "x", "", "", ""), (1, "cd", "y", "", "", "")], DOCS).where(~langid.held_out(F.col("doc_id")))
    model = langid.fit(model_docs)
    one = [model.judge([t])[0][0] for t in texts]
    assert model.judge(texts)[0] == one
    for n in langid.NGRAMS:
        b = langid.buckets_of(points, n, 1 << 15)
        for k, t in enumerate(texts):
            own = langid.code_points([t])[0]
            assert list(b[at[k] : at[k + 1] - n + 1]) == list(langid.buckets_of(own, n, 1 << 15))


def test_language_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None, None, "", "")], DOCS)
    assert [r["lang_pred"] for r in langid.report(docs).collect()] == ["und"]
    assert langid.report(docs.where("false")).count() == 0


# ---- licences -----------------------------------------------------------------


def _plain_best(texts):
    """Best licence of each text: cosine of every unit to every template, words weighted over all units."""
    units = {}
    for i, t in enumerate(texts):
        units[i] = []
        for line in (t or "").split("\n"):
            w = licenses.words_of(line)
            n, step = licenses.UNIT_WORDS, licenses.UNIT_WORDS // 2
            units[i] += [w] if 0 < len(w) <= n else [w[s : s + n] for s in range(0, len(w) - step, step)] if w else []
    every = [u for us in units.values() for u in us]
    known = {w for ts in licenses.TEMPLATES.values() for t in ts for w in licenses.words_of(t)}
    idf = lambda w: math.log((1 + len(every)) / (1 + (sum(w in u for u in every) if w in known else 1))) + 1
    cache = {}
    weight = lambda w: cache.setdefault(w, idf(w))
    vector = lambda ws: {w: c * weight(w) for w, c in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    best = {}
    for i, us in units.items():
        found = []
        for u in us:
            a = vector(u)
            for name, ts in licenses.TEMPLATES.items():
                for t in ts:
                    b = vector(licenses.words_of(t))
                    s = sum(a[w] * b.get(w, 0) for w in a) / norm(a) / norm(b)
                    found.append((-round(s, 9), name))
        if found and -min(found)[0] >= licenses.THRESHOLD:
            best[i] = min(found)[1]
    return best


def test_licences_equal_plain_cosines(spark):
    r = random.Random(6)
    prose = lambda n: _text(r, "the of and work use version free this is under to a file".split() + ["ka", "lo"], n)
    texts = [prose(r.randint(5, 120)) for _ in range(40)]
    texts += ["intro words\nLicensed under CC BY-NC 4.0.\nmore", "released under the mit license", "Licensed under the Apache License, Version 2.0", None, "", "All rights reserved. 2019 someone else here with quite some more words on it", " ".join([prose(300), "This work is licensed under the GNU General Public License, version 3.", prose(300)])]
    rows = [(i, f"a/d{i}", t, "x", "y") for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string, dir string, h string")).collect()
    assert {r["doc_id"]: r["license"] for r in got if r["how"] == "own"} == _plain_best(texts)


def test_licence_files_are_inherited_from_the_nearest_folder(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "LICENSE", mit),
        (2, "a/b/COPYING", gpl),
        (3, "a/x", "plain words"),
        (4, "a/b/c/d/y", "plain words"),
        (5, "a/b/z", "text\n" * 60 + "Licensed under CC BY 4.0."),
        (6, None, None),
        (7, "a/bc/q", ""),
        (7, "a/bc/q", ""),
    ]
    got = {r["doc_id"]: (r["license"], r["how"], r["license_dir"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "own", None),
        2: ("GPL-3.0", "own", None),
        3: ("MIT", "inherited", ""),
        4: ("GPL-3.0", "inherited", "a/b"),
        5: ("CC-BY-4.0", "own", None),
        6: ("MIT", "inherited", ""),
        7: ("MIT", "inherited", ""),
    }
    assert licenses.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


# ---- urls ---------------------------------------------------------------------


def _plain_rule(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(r), r, v) for r, v in urls.RULES for h, s, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_rules_equal_plain_matching(spark):
    given = [None, "", "nohost", "http://", "http://A.Example.COM/en/x?y=1#z", "https://www.example.com/en/", "x://www.example.com/en", "http://net/es/1", "http://b.net/fr/?q", "http://bnet/fr/", "http://example.com", "http://example.com?x/en/", "http://com#/", "http://x.org/a\nb", "a://b://c.com/d", "http://" + "a" * 50_000 + ".com/"]
    rows = [(i, u, "x", "y") for i, u in enumerate(given)] + [(1, "http://example.com/en/", "", "")] * 2
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string, host string, rule string"), spark.createDataFrame([], "url string, y int")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["id"] != 1:
            host, path, rule, verdict = _plain_rule(given[r["id"]])
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_trees_learn_lexical_signs(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    good = [f"https://{word()}.org/{word()}/{word()}" for _ in range(300)]
    bad = [f"http://{r.randrange(10**6)}-{word()}.biz/{word()}?a={r.randrange(99)}&b={word()}&c=1" for _ in range(300)]
    known = spark.createDataFrame([(u, 0) for u in good[:200]] + [(u, 1) for u in bad[:200]] + [(None, 1), ("x", None)], "url string, y int")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(good[200:] + bad[200:])], "page_id long, url string")
    got = {x["id"]: x["verdict"] for x in urls.judged(pages, known, rules=()).collect()}
    assert sum(v == ("allow" if i < 100 else "block") for i, v in got.items()) >= 196
    assert urls.judged(pages.where("false"), known).count() == 0
