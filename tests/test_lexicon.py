"""Substring search through the filter of beginnings, removal, segmentation: against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuswash.functions import places
from corpuswash.operators import lexicon, segmentation
from corpuswash.operators.lexicon import Lexicon
from corpuswash.plans.clean import Extensions, Lexicons, clean
from corpuswash.plans.config import CleanConfig


def words_frame(spark, words):
    return Lexicon.of(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, ord long"))


def plain_hits(texts, words):
    known = list(dict.fromkeys(w.strip() for w in words if w.strip()))
    return sorted((k, p + len(w) - 1, w) for k, t in texts for w in known for p in range(len(t) - len(w) + 1) if t.startswith(w, p))


def hits(spark, texts, lex):
    rows = spark.createDataFrame([(k, t, "clash") for k, t in texts], "k long, t string, word string").repartition(3)
    return sorted((r["k"], r["end"], r["word"]) for r in lexicon.substring_hits(rows, F.col("t"), lex, ["k"]).collect())


@pytest.mark.parametrize("least", [1, 2, 3, 5, 9])
def test_hits_equal_plain_search(spark, least):
    rng = random.Random(least)
    make = lambda n: "".join(rng.choice("ab中é🐹\n ") for _ in range(n))
    words = [make(rng.randint(least, least + 12)) for _ in range(60)]
    texts = [(i, make(rng.randint(0, 90))) for i in range(50)] + [(50, ""), (51, "a"), (52, "".join(words))]
    lex = words_frame(spark, words)
    assert hits(spark, texts, lex) == plain_hits(texts, words)


def test_null_texts_empty_lists_and_repeated_rows(spark):
    lex = words_frame(spark, ["ab", " ab ", "", "b"])
    rows = spark.createDataFrame([(1, None), (2, "xab"), (2, "xab")], "k long, t string")
    got = [(r["k"], r["end"], r["word"]) for r in lexicon.substring_hits(rows, F.col("t"), lex, ["k"]).collect()]
    assert sorted(got) == sorted([(2, 2, "ab"), (2, 2, "b")] * 2)
    assert lexicon.substring_hits(rows, F.col("t"), words_frame(spark, []), ["k"]).collect() == []
    assert lexicon.substring_hits(rows.limit(0), F.col("t"), lex, ["k"]).collect() == []


def test_a_line_of_ten_thousand_characters(spark):
    """Long words cost the places nothing: they carry at most AHEAD characters."""
    rng = random.Random(2)
    line = "".join(rng.choice("abcdefgh中") for _ in range(10_000))
    other = line[:5_000] + "x" + line[5_001:]
    words = [line, line[:300], "zz", line[1:258]]
    texts = [(1, f"__{line}__{other}zz"), (2, other), (3, line[:-1]), (4, line)]
    lex = words_frame(spark, words)
    assert lex.max_len == 10_000
    assert hits(spark, texts, lex) == plain_hits(texts, words)
    rows = spark.createDataFrame(texts, "k long, t string")
    kept = rows.mapInArrow(places.candidates(lexicon.beginnings(lex), lexicon.AHEAD), "k long, n int, at int, ahead string")
    most = kept.agg(F.max(F.length("ahead")).alias("most"), F.count("*").alias("n")).first()
    assert most["most"] <= lexicon.AHEAD and most["n"] < 1_000


def test_windows_do_not_lose_places(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 200))) for _ in range(30)]
    words = [f"{a}{b}{c}{d}" for a in "ab" for b in "bc" for c in "ac" for d in "abc"]
    data = np.zeros(1 << 9, np.uint8)
    for at in np.concatenate(places.Beginnings.places(places.beginning_hashes(words), 12)).tolist():
        data[at >> 3] |= 1 << (at & 7)
    found = places.Beginnings(12, data, (4,))
    for window in (1 << 20, 64, 7):
        monkeypatch.setattr(places, "WINDOW", window)
        got = {(int(r), int(p)) for _, row, at in found.scan(texts) for r, p in zip(row, at, strict=True)}
        assert got >= {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 3) if t[p : p + 4] in words}
        assert all(p + 4 <= len(texts[i]) for i, p in got)


def test_the_filter_keeps_few_other_places(spark):
    """A list of 20 000 words; text without any of them leaves the scan nearly empty."""
    rng = random.Random(1)
    words = {"".join(rng.choice("abcdefghijkl") for _ in range(10)) for _ in range(20_000)}
    lex = words_frame(spark, sorted(words))
    text = "".join(rng.choice("mnopqrstuvwx") for _ in range(100_000))
    n = sum(len(at) for _, _, at in lexicon.beginnings(lex).scan([text]))
    assert n < 2_000


@pytest.mark.parametrize("seed", range(4))
def test_removal_equals_one_word_after_the_other(spark, seed):
    rng = random.Random(seed)
    words = ["ab", "ba", "aab", "b", "cc", "abc", "c a"][: rng.randint(3, 7)]
    texts = [(i, "".join(rng.choice("aabbc ") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    lex = words_frame(spark, words)
    rows = spark.createDataFrame([("d", "f", i, 0, 0, t) for i, t in texts], "dataset string, file_id string, session_id long, turn long, part int, text string")
    got = {r["session_id"]: (r["text"], r["black_word"]) for r in lexicon.remove_substrings(rows, lex).collect()}
    for i, t in texts:
        found = sorted(((p + len(w) - 1, -len(w), w) for w in words for p in range(len(t)) if t.startswith(w, p)))
        out = t
        for *_, w in found:
            out = out.replace(w, "")
        assert got[i] == (out, found[-1][2] if found else None)


# ---- words of unspaced text ---------------------------------------------------


def plain_path(text, costs, unknown):
    """All splits of a short text: cheapest, then fewest words, then by the lengths from the end, longer first."""
    def splits(t):
        if not t:
            yield []
        for n in range(1, len(t) + 1):
            if n == 1 or t[:n] in costs:
                for rest in splits(t[n:]):
                    yield [t[:n], *rest]

    price = lambda w: min(costs.get(w, unknown), unknown) if len(w) == 1 else costs[w]
    return min(splits(text), key=lambda s: (sum(map(price, s)), len(s), [-len(w) for w in reversed(s)]))


def test_best_path_against_all_splits():
    rng = random.Random(3)
    for _ in range(300):
        words = {"".join(rng.choice("天地人abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 12))}
        costs = {w: rng.randint(0, 40) * 10 for w in words}
        text = "".join(rng.choice("天地人abc") for _ in range(rng.randint(1, 9)))
        hits = [(p, len(w), c) for w, c in costs.items() for p in range(len(text)) if text.startswith(w, p)]
        assert segmentation.words_of(text, hits, 300, whole=True) == plain_path(text, costs, 300)


def test_words_of_chinese_text_reach_the_word_rules(spark):
    counted = [("今天", 50), ("天气", 40), ("真", 30), ("好", 60), ("今", 3), ("天", 5), ("气", 2), ("真好", 9), ("坏话", 1), ("坏 话", 9), ("", 4), ("天气", 10), ("零", 0)]
    words = segmentation.Dictionary.of(spark.createDataFrame(counted, "word string, count long"))
    rows = [(0, "今天天气真好 ok真的,今天"), (1, "你说坏话"), (2, None), (3, ""), (4, "plain words"), (5, "天" * 5000), (6, " 今天\n天气 ")]
    df = spark.createDataFrame([("d", "f", 0, i, 0, t) for i, t in rows], "dataset string, file_id string, session_id long, turn long, part int, text string")
    key = ["dataset", "file_id", "session_id", "turn", "part"]
    out = segmentation.segmented(df, F.col("text"), words, "w", key)
    got = {r["turn"]: r["w"] for r in out.collect()}
    assert got[0] == ["今天", "天气", "真好", "ok", "真", "的", ",", "今天"]
    assert got[1] == ["你", "说", "坏话"]
    assert got[2] == got[3] == []
    assert got[4] == ["plain", "words"] and got[5] == ["天"] * 5000 and got[6] == ["今天", "天气"]
    bad = words_frame(spark, ["坏话", "天"])
    facts = lexicon.word_facts(out, F.col("w"), key, blacklist=bad).collect()
    assert sorted((r["turn"], r["black_token"]) for r in facts) == [(1, "坏话"), (5, "天")]
    assert segmentation.segmented(df.limit(0), F.col("text"), words, "w", key).collect() == []


def test_the_job_uses_the_dictionary(spark):
    words = segmentation.Dictionary.of(spark.createDataFrame([("天气", 5), ("坏话", 5), ("说", 5)], "word string, count long"))
    df = spark.createDataFrame([("d", "f", 0, i, 0, t) for i, t in enumerate(["说坏话", "天气好", "hello there"])], "dataset string, file_id string, session_id long, turn long, part int, text string")
    cfg = CleanConfig().on("no_word_blacklist", "yda_dedupl")
    lex = Lexicons(word_blacklist=words_frame(spark, ["坏话"]))
    got = sorted((r["turn"], r["text"]) for r in clean(df, cfg, lex, Extensions(dictionary=words)).segments.collect())
    assert got == [(1, "天气 好"), (2, "hello there")]
