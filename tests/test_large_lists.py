"""Work done once, and word lists too long to broadcast: same results as the short way."""

import random

import pytest
from pyspark.sql import functions as F

from corpuswash.functions import text as T
from corpuswash.operators import blocks as B
from corpuswash.operators import classify, corpus, lexicon, segmentation, sessions
from corpuswash.operators.lexicon import Lexicon
from corpuswash.plans import scale
from corpuswash.plans.clean import Lexicons, clean
from corpuswash.plans.config import CleanConfig
from corpuswash.sources import writers
from workload import queries

SCHEMA = "dataset string, file_id string, session_id long, turn long, part int, text string"


@pytest.fixture
def counted(spark):
    """A table whose texts are counted each time they are made."""
    made = spark.sparkContext.accumulator(0)

    def of(rows, schema=SCHEMA):
        @F.udf("string")
        def text(t):
            made.add(1)
            return t

        return spark.createDataFrame(rows, schema).repartition(2, "session_id").withColumn("text", text("text"))

    return of, made


def lexicon_of(spark, words):
    return Lexicon.of(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, ord long"))


@pytest.fixture
def short_bound(monkeypatch):
    for module in (scale, lexicon):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 3)


def texts(n=40, seed=2):
    r = random.Random(seed)
    return [" ".join(r.choice(["the", "the", "a", "Fox", "dog", "zorn", "und", "x1", *[f"q{chr(97 + i)}v" for i in range(9)]]) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_rules_run_once_under_all_lexicon_joins(spark, counted):
    of, made = counted
    rows = [("d", "f", s, t, 0, f"badword number {s} {t} longtopic") for s in range(5) for t in range(4)]
    words = [f"badword{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    lex = lexicon_of(spark, ["badword", *words])
    cfg = CleanConfig().on("no_utter_dup", "no_special_topic", "no_str_blacklist", "no_word_blacklist", "no_ad")
    out = clean(of(rows), cfg, Lexicons(str_blacklist=lex, word_blacklist=lex, special_topic=lexicon_of(spark, words)))
    assert out.segments.count() == 20
    assert made.value == 20


def test_audit_is_made_once_when_written(spark, counted, tmp_path):
    of, made = counted
    rows = [("d", "f", s, 0, 0, f"hello badword {s % 3}") for s in range(9)]
    audit = of(rows).withColumns({"category": F.lit("str_blacklist"), "reason": F.lit("badword"), "after": F.lit(None).cast("string")}).withColumnRenamed("text", "before")
    writers.write_audit(audit, f"{tmp_path}/audit")
    assert made.value == 9
    assert spark.read.json(f"{tmp_path}/audit/word_counts").first()["utterances"] == 3
    assert spark.read.json(f"{tmp_path}/audit/word_utterances").count() == 3
    writers.write_audit(audit.where("false"), f"{tmp_path}/none")
    assert spark.read.schema("word string").json(f"{tmp_path}/none/word_counts").count() == 0


def test_generic_cut_makes_its_segments_once(spark, counted, monkeypatch):
    of, made = counted
    rows = [("d", "f", s, t, 0, "lololololo" if t else f"question {s}") for s in range(30) for t in range(4)]
    segments = sessions.segment(B.with_block(of(rows)), False)
    monkeypatch.setattr(queries, "_segments", lambda spark, sf: (segments, False))
    got = queries.generic_cut(spark, "").groupBy("session_id").agg(F.collect_set("turn").alias("t")).collect()
    assert made.value == 120
    assert len(got) == 30 and all(set(r["t"]) == {0, 1} for r in got)


def test_covering_trigrams_equal_plain_counts():
    r = random.Random(3)
    some = ["", "ab", "abc", "aaaa", "ababab", "lol lol", "🐹🐹🐹🐹", "哈哈哈哈x"]
    for t in some + ["".join(r.choice("ab🐹") for _ in range(r.randint(0, 14))) for _ in range(600)]:
        grams = [t[i : i + 3] for i in range(len(t) - 2)]
        assert set(corpus.covering(t)) == {g for g in grams if grams.count(g) * 30 > len(t) * 9}


def test_noise_words_against_a_long_english_list(spark, short_bound):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts(), None])] + [(3, "the"), (60, "a zorn"), (60, "a zorn"), (None, "zorn")], "k long, t string")
    english = lexicon_of(spark, ["the", "a", "fox", "dog", "qav", "qbv"])
    assert not english.small
    got = sorted((r["k"] is None, r["k"], r["noise_word"]) for r in lexicon.word_facts(rows, T.tokens(F.col("t")), ["k"], english=english).collect())
    want = {}
    for k, t in [(r["k"], r["t"]) for r in rows.collect() if r["t"]]:
        for pos, w in enumerate(t.split()):
            if w.isalpha() and w.lower() not in ("the", "a", "fox", "dog", "qav", "qbv"):
                want.setdefault(k, []).append((pos, w))
    assert got == sorted((k is None, k, min(v)[1]) for k, v in want.items())


def test_offence_scores_with_long_weights(spark, short_bound):
    data = [(i, t, i % 2) for i, t in enumerate(texts())]
    frame = spark.createDataFrame([*data, (90, "new words only", None), (91, None, None)], "id long, text string, toxic int")
    labelled = classify.join_labels(frame.select("id", "text"), frame.select("id", "toxic").where("id < 30"), "id", "toxic")
    weights, other, odds = classify.token_weights(labelled)
    known = {r["token"]: r["weight"] for r in weights.collect()}
    assert len(known) > 3
    got = {r["id"]: r["offensive"] for r in classify.counted_scores(frame.select("id", "text"), labelled, "id").collect()}
    import re

    assert got == {i: round(sum(known.get(w, other) for w in re.findall(classify.TOKEN, t or "")) + odds, 6) > 0 for i, t in [(r["id"], r["text"]) for r in frame.collect()]}


def test_the_most_frequent_keys_fit_the_bound(spark, short_bound):
    table = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([100, 60, 3, 3, 2, 1, None])], "w string, n long")
    often, seldom = scale.by_frequency(table, "n")
    assert sorted(r["w"] for r in often.collect()) == ["w0", "w1"]
    assert seldom.count() == 5


def test_every_different_token_is_searched_once(spark, monkeypatch):
    seen, plain = [], lexicon.substring_hits

    def watched(rows, *rest):
        seen.append(rows.count())
        return plain(rows, *rest)

    monkeypatch.setattr(lexicon, "substring_hits", watched)
    rows = spark.createDataFrame([(i, "fine xtopic1x words fine topic2") for i in range(50)] + [(50, None), (51, "fine")], "k long, t string")
    lex = lexicon_of(spark, [f"topic{i}" for i in range(70)])
    got = {r["k"]: r["w"] for r in lexicon.confused_tokens(rows, T.tokens(F.col("t")), lex, "w", ["k"]).collect()}
    assert got == {**{i: "xtopic1x" for i in range(50)}, 50: None, 51: None}
    assert seen == [4]


def test_hits_of_a_long_list_are_whole_words(spark, short_bound):
    r = random.Random(7)
    make = lambda n: "".join(r.choice("ab中é🐹\n ") for _ in range(n))
    words = [*{make(r.randint(1, 14)).strip() for _ in range(60)} - {""}, "ab" * 200, "ab" * 128 + "é"]
    data = [(i, make(r.randint(0, 90))) for i in range(40)] + [(50, ""), (51, "ab" * 201), (52, "ab" * 128 + "éa"), (53, None)]
    lex = lexicon_of(spark, words)
    assert not lex.small
    rows = spark.createDataFrame(data, "k long, t string").repartition(3)
    got = sorted((x["k"], x["end"], x["word"]) for x in lexicon.substring_hits(rows, F.col("t"), lex, ["k"]).collect())
    assert got == sorted((k, p + len(w) - 1, w) for k, t in data if t for w in words for p in range(len(t) - len(w) + 1) if t.startswith(w, p))
    sent = lexicon.beginnings(lex), lexicon.whole_words(lex)
    kept = rows.where("t IS NOT NULL").mapInArrow(lambda b: lexicon.places.candidates(sent[0], lexicon.AHEAD, sent[1])(b), "k long, n int, at int, ahead string")
    kept = kept.collect()
    assert all(len(x["ahead"]) == x["n"] for x in kept)
    heads = {w[: lexicon.AHEAD] for w in words}
    assert sum(x["ahead"] not in heads for x in kept) < 0.1 * len(kept)


def test_lattice_hits_and_paths_of_a_small_dictionary(spark):
    r = random.Random(5)
    words = list({"".join(r.choice("ab中é🐹") for _ in range(r.randint(1, 6))) for _ in range(40)})
    data = [(i, "".join(r.choice("ab中é🐹 x") for _ in range(r.randint(0, 40)))) for i in range(60)] + [(60, ""), (61, None)]
    rows = spark.createDataFrame(data, "k long, t string")
    known = segmentation.Dictionary.of(spark.createDataFrame([(w, 1 + i % 7) for i, w in enumerate(words)], "word string, count long"))
    costs = {x["word"]: x["cost"] for x in known.costs.collect()}
    lattice = segmentation.Lattice.of(list(costs), segmentation.np.array(list(costs.values())))
    for _, t in data[:60]:
        want = sorted((p, len(w), c) for w, c in costs.items() for p in range(len(t)) if t.startswith(w, p))
        assert sorted(lattice.hits(["xx", t, ""])[1]) == want
    got = segmentation.segmented(rows, F.col("t"), known, "w", ["k"], whole=True)
    assert "MapInArrow" in got._jdf.queryExecution().toString() and "collect_list" not in got._jdf.queryExecution().toString()
    for x in got.collect():
        t = x["t"] or ""
        hits = [(p, len(w), c) for w, c in costs.items() for p in range(len(t)) if t.startswith(w, p)]
        assert x["w"] == segmentation.words_of(t, hits, known.unknown, whole=True)


@pytest.mark.parametrize("size", [1024, 3])
def test_names_by_first_place_without_a_map_for_each_turn(spark, size):
    rows = [("d", "f", 1, t, 0, x, "kept") for t, x in enumerate(["Tom met Ann", "Ann met  Bob Tom", "", "x Zoe", "Bob Zoe Ann"])]
    rows += [("d", "f", 2, 0, 0, "no names", "kept"), ("d", None, 3, 0, 0, "Tom here", "kept"), ("d", "f", 4, None, 0, "Bob Tom", "kept"), ("d", "f", 4, 1, 0, "Tom", "kept"), ("d", "f", 5, 0, 0, None, "kept")]
    frame = spark.createDataFrame(rows, SCHEMA + ", extra string").withColumnRenamed("extra", "note")
    names = lexicon_of(spark, ["Tom", "Ann", "Bob", "Zoe"])
    out = sessions.rename_names(B.with_block(frame, size), names, size < 1024)
    assert out.columns == [*frame.columns, "block"]
    assert "map_from_entries" not in out._jdf.queryExecution().toString()
    got = {(r["file_id"], r["session_id"], r["turn"]): r["text"] for r in out.collect()}
    assert [got["f", 1, t] for t in range(5)] == ["<NAME1> met <NAME2>", "<NAME2> met <NAME3> <NAME1>", "", "x <NAME4>", "<NAME3> <NAME4> <NAME2>"]
    assert got["f", 2, 0] == "no names" and got[None, 3, 0] == "Tom here" and got["f", 4, None] == "Bob Tom" and got["f", 5, 0] is None
    assert got["f", 4, 1].startswith("<NAME")


def test_a_block_asks_once_for_each_seldom_word_of_a_long_dictionary(spark, short_bound, monkeypatch):
    r = random.Random(11)
    words = list({"".join(r.choice("ab中é🐹") for _ in range(r.randint(1, 6))) for _ in range(40)} | {"ab" * 150})
    data = [(i, "".join(r.choice("ab中é🐹 x\n") for _ in range(r.randint(0, 40)))) for i in range(60)] + [(60, ""), (61, None), (62, "ab" * 400), (62, "ab" * 400), (None, "ab")]
    rows = spark.createDataFrame(data, "k long, t string").repartition(3)
    known = segmentation.Dictionary.of(spark.createDataFrame([(w, 1 + i % 7) for i, w in enumerate(words)], "word string, count long"))
    assert not known.lexicon.small
    costs = {x["word"]: x["cost"] for x in known.costs.collect()}

    def want(t):
        hits = [(p, len(w), c) for w, c in costs.items() for p in range(len(t)) if t.startswith(w, p)]
        return segmentation.words_of(t, hits, known.unknown, whole=True)

    for block in (1 << 20, 100):
        monkeypatch.setattr(segmentation, "BLOCK", block)
        out = segmentation.segmented(rows, F.col("t"), known, "w", ["k"], whole=True)
        assert "collect_list" not in out._jdf.queryExecution().toString()
        got = sorted(((x["k"], x["t"] or "", x["w"]) for x in out.where("k IS NOT NULL").collect()), key=lambda x: x[:2])
        assert got == sorted(((k, t or "", want(t or "")) for k, t in [*data[:-1], *data[62:64]] if k is not None), key=lambda x: x[:2])
    place = "ab" * 400
    filters = segmentation._filters(known.costs)
    found = segmentation.may_hold(*filters, [place, "x", place])
    assert {w for w in words if w in place} <= found and len(found) < 12  # 800 places, one row a word
    assert segmentation.segmented(rows.limit(0), F.col("t"), known, "w", ["k"], whole=True).collect() == []
