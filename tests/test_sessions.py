"""Session, lexicon and corpus passes against plain statements of the rules.

Every pass runs twice: with all turns in one block, and with blocks of two or three turns, which
forces the carry between blocks that very long sessions need.
"""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpuswash.functions import text as T
from corpuswash.model import SEGMENT, SESSION, UTTERANCE
from corpuswash.operators import blocks as B
from corpuswash.operators import corpus, lexicon, sessions, stats
from corpuswash.operators.lexicon import Lexicon
from corpuswash.plans.clean import NEEDS, Lexicons, clean
from corpuswash.plans.config import CleanConfig
from corpuswash.sources import readers
from corpuswash.streaming.rowchain import NOT_STREAMED, clean_stream

SCHEMA = "dataset string, file_id string, session_id long, turn long, part int, text string"
AD = "buy three garden hoses right now"
BLOCKS = [1024, 3, 2]


def table(spark, dialogs):
    rows = [("d", "f", s, i, 0, t) for s, turns in enumerate(dialogs) for i, t in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def collect(df, key=SESSION):
    out = defaultdict(list)
    for r in df.orderBy(*UTTERANCE).collect():
        out[tuple(r[k] for k in key)].append(r["text"])
    return out


def dialogs(words, n, length, seed):
    rnd = random.Random(seed)
    return [[rnd.choice(words) for _ in range(rnd.randint(1, length))] for _ in range(n)]


def blocked(spark, data, size):
    rows = table(spark, data)
    long = B.is_long(rows, size)
    return B.with_block(rows, size), long


def runs(turns):
    out = [[]]
    for t in turns:
        out[-1].append(t) if t else out.append([])
    return [r for r in out if r]


def trim(segment):
    """Up to the last turn with two characters or more."""
    last = max((i for i, t in enumerate(segment) if len(t.replace(" ", "")) > 1), default=-1)
    return segment[: last + 1]


@pytest.mark.parametrize("size", BLOCKS)
@pytest.mark.parametrize("short", [False, True])
def test_segments(spark, size, short):
    data = dialogs(["", "a", "x y", "hello"], 40, 14, 1)
    rows, long = blocked(spark, data, size)
    got = sorted(collect(sessions.segment(rows, long, no_short_response=short), SEGMENT).values())
    want = [trim(s) if short else s for d in data for s in runs(d)]
    assert got == sorted(s for s in want if s)


@pytest.mark.parametrize("size", BLOCKS)
def test_multi_turn_segments(spark, size):
    data = dialogs(["", "a", "bb"], 40, 12, 2)
    rows, long = blocked(spark, data, size)
    got = sorted(collect(sessions.segment(rows, long, min_turns=2), SEGMENT).values())
    assert got == sorted(s for d in data for s in runs(d) if len(s) > 1)


@pytest.mark.parametrize("size", BLOCKS)
def test_uniform_sessions(spark, size):
    data = dialogs(["a", "b"], 60, 5, 3)
    rows, long = blocked(spark, data, size)
    kept, log = sessions.drop_uniform(rows, long)
    assert sorted(collect(kept).values()) == sorted(d for d in data if len(set(d)) > 1)
    assert sorted(r["before"] for r in log.collect()) == sorted(d[0] for d in data if len(set(d)) < 2)
    names = {r["session_id"] for r in sessions.uniform_sessions(rows).collect()}
    assert names == {i for i, d in enumerate(data) if len(set(d)) < 2}


@pytest.mark.parametrize("size", BLOCKS)
def test_names(spark, size):
    data = dialogs(["tom sees  ann", "bob", "ann and tom", "", "no name", "bob bob tom"], 30, 9, 4)
    names = Lexicon.of(spark.createDataFrame([("tom", 0), ("ann", 1), ("bob", 2)], "word string, ord long"))
    rows, long = blocked(spark, data, size)

    def rename(turns):
        seen = {}
        return [" ".join(seen.setdefault(w, f"<NAME{len(seen) + 1}>") if w in ("tom", "ann", "bob") else w for w in t.split()) for t in turns]

    got = collect(sessions.rename_names(rows, names, long))
    assert [got[("d", "f", i)] for i in range(len(data))] == [rename(d) for d in data]


def borders(places, gap):
    """Hits at which a piece ends: each more than ``gap`` turns after the piece began."""
    last = -1
    for p in places:
        if p - last - 1 > gap:
            last = p
            yield p


def cut(turns, hit, gap):
    ends = [-1, *borders([i for i, t in enumerate(turns) if hit(t)], gap), len(turns)]
    *pieces, last = [turns[a + 1 : b] for a, b in zip(ends, ends[1:], strict=False)]
    return [*pieces, last] if len(last) > 1 else pieces


@pytest.mark.parametrize("size", BLOCKS)
def test_ads(spark, size):
    data = dialogs([AD, "a", "b", "c", "d", "hello hello hello hello"], 40, 16, 5)
    rows, long = blocked(spark, data, size)
    rows = rows.withColumn("segment", F.lit("0"))
    contexts = defaultdict(set)
    for d in data:
        for prev, t in zip(d, d[1:]):
            contexts[t].add(prev)
    ads = {t: len(c) for t, c in contexts.items() if len(t.replace(" ", "")) > 20 and len(c) > 2}
    found = corpus.ad_responses(rows, long)
    assert {r["text"]: r["contexts"] for r in found.collect()} == ads
    got = sorted(collect(corpus.cut_ads(rows, found, long), SEGMENT).values())
    assert got == sorted(p for d in data for p in cut(d, lambda t: t in ads, 2))


@pytest.mark.parametrize("size", BLOCKS)
def test_generic(spark, size):
    data = dialogs(["lollollol", "ha ha ha ha", "a b", "something else", "xyz", "q"], 40, 14, 6)
    rows, long = blocked(spark, data, size)
    rows = rows.withColumn("segment", F.lit("0"))

    def grams(t):
        t = t.replace(" ", "")
        return [t[i : i + 3] for i in range(len(t) - 2)]

    counts = defaultdict(int)
    for d in data:
        for t in d[1:]:
            for g in set(grams(t)):
                counts[g] += 1
    table_ = corpus.trigram_counts(rows, long=long)
    assert {r["trigram"]: r["responses"] for r in table_.collect()} == counts
    common = {g for g, n in counts.items() if n > 30}

    def generic(t):
        g = grams(t)
        return any(x in common and 0.9 < 3 * g.count(x) / len(t.replace(" ", "")) for x in g)

    got = sorted(collect(corpus.cut_generic(rows, corpus.generic_trigrams(table_, 30), long), SEGMENT).values())
    assert got == sorted(p for d in data for p in cut(d, generic, 1))


def test_many_blocks_compose_in_levels(spark, monkeypatch):
    monkeypatch.setattr(B, "_FAN", 2)
    data = [dialogs([AD, AD, "a", "b", "c"], 1, 60, 7)[0] * 2]
    rows = B.with_block(table(spark, data), 2).withColumn("segment", F.lit("0"))
    out = B.cut_pieces(rows, F.col("text") == AD, 2, True, SEGMENT)
    got = defaultdict(list)
    for r in out.orderBy("turn").collect():
        got[r["piece"]].append(r["text"])
    assert [got[k] for k in sorted(got)] == cut(data[0], lambda t: t == AD, 2)


# ---- lexicons -------------------------------------------------------------


def hits_in_order(text, words):
    found = [(i + len(w) - 1, -len(w), w) for w in words for i in range(len(text)) if text.startswith(w, i)]
    return [w for _, _, w in sorted(found)]


def remove(text, words):
    order = hits_in_order(text, words)
    for w in order:
        text = text.replace(w, "")
    return text, order[-1] if order else None


def test_substring_removal_order(spark):
    words = Lexicon.of(spark.createDataFrame([(w, i) for i, w in enumerate(["b", "ab", "abc", "cd"])], "word string, ord long"))
    rows = table(spark, [["xabcd b"]])
    got = lexicon.remove_substrings(rows, words).first()
    assert (got["text"].strip(), got["black_word"]) == ("x", "b")


def test_substring_removal_random(spark):
    rnd = random.Random(8)
    words = sorted({"".join(rnd.choice("abc你🐹") for _ in range(rnd.randint(1, 7))) for _ in range(40)})
    texts = ["".join(rnd.choice("abc你🐹 ") for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    texts += ["".join(rnd.choice("abc ") for _ in range(900)) for _ in range(3)]
    lex = Lexicon.of(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, ord long"))
    got = lexicon.remove_substrings(table(spark, [[t] for t in texts]), lex).orderBy("session_id").collect()
    assert [(r["text"], r["black_word"]) for r in got] == [remove(t, words) for t in texts]


def test_large_lexicon_takes_the_salted_join(spark, monkeypatch):
    lex = Lexicon.of(spark.createDataFrame([("abcdef", 0), ("zz", 1)], "word string, ord long"))
    big = Lexicon(lex.df, 10**9, 10**12, lex.max_len, lex.prefix_lens)
    rows = table(spark, [["xabcdefx zz"], ["nothing"]])
    assert not big.small
    got = {r["word"] for r in lexicon.substring_hits(rows, F.col("text"), big, UTTERANCE).collect()}
    assert got == {"abcdef", "zz"}


def test_lexicon_keeps_the_first_place(spark):
    listed = spark.createDataFrame([(" a ", 0), ("b", 1), ("a", 2), ("", 3), ("c", 4), ("d", 5)], "word string, ord long")
    lex = Lexicon.of(listed, first=4)
    assert {(r["word"], r["ord"]) for r in lex.df.collect()} == {("a", 0), ("b", 1), ("c", 4)}


def test_first_words_of_a_list_in_many_splits(spark, tmp_path):
    (tmp_path / "b.txt").write_text("\n".join(f"w{i}" if i % 7 else "" for i in range(20_000)))
    (tmp_path / "a.txt").write_text("\n\nfirst\n \nsecond\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = Lexicon.of(readers.word_list(spark, str(tmp_path)), first=10_000).df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    listed = ["first", "second", *[f"w{i}" for i in range(20_000) if i % 7]]
    assert {r["word"] for r in got} == set(listed[:10_000])
    assert {r["word"]: r["ord"] for r in got}["w1"] == 2


def test_negative_and_sparse_turns(spark):
    rows = [("d", "f", 0, t, 0, x) for t, x in [(-2, "a"), (-1, ""), (0, "b"), (1, "c"), (10**12, "d"), (10**12 + 1, ""), (10**13, "e")]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect(sessions.segment(B.with_block(df), B.is_long(df)), SEGMENT)
    assert sorted(got.values()) == [["a"], ["b", "c", "d"], ["e"]]


def test_first_contained_both_ways(spark):
    few = Lexicon.of(spark.createDataFrame([("zz", 0), ("aa", 1)], "word string, ord long"))
    many = Lexicon.of(spark.createDataFrame([("zz", 0), ("aa", 1)] + [(f"word{i}", i + 2) for i in range(80)], "word string, ord long"))
    rows = table(spark, [["aa zz"], ["xaa"], ["none"]])
    for lex in (few, many):
        got = lexicon.first_contained(rows, F.col("text"), lex, "w", UTTERANCE).orderBy("session_id").collect()
        assert [r["w"] for r in got] == ["zz", "aa", None]


def test_last_alternation_equals_a_pattern(spark):
    rnd = random.Random(4)
    words = list(dict.fromkeys(["a.b", "a+b", "\\E"] + ["".join(rnd.choice("ab.+") for _ in range(rnd.randint(1, 4))) for _ in range(30)]))
    rnd.shuffle(words)
    texts = ["a.b a+b axb", "", "xyz"] + ["".join(rnd.choice("ab.+ ") for _ in range(rnd.randint(0, 40))) for _ in range(150)]
    lex = Lexicon.of(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, ord long"))
    got = lexicon.last_alternation(table(spark, [[t] for t in texts]), F.col("text"), lex, "w", UTTERANCE).orderBy("session_id").collect()
    pattern = re.compile("|".join(map(re.escape, words)))
    assert [r["w"] for r in got] == [(pattern.findall(t) or [None])[-1] for t in texts]


def test_rules_without_their_list_are_refused(spark):
    rows = table(spark, [["a", "b"]])
    for flag in NEEDS:
        with pytest.raises(ValueError, match=flag):
            clean(rows, CleanConfig().on(flag))
    with pytest.raises(ValueError, match="audit"):
        clean(rows, CleanConfig(audit=False).on("check_confuse_word"), Lexicons(confuse=Lexicon.of(spark.createDataFrame([("a", 0)], "word string, ord long"))))
    for flag in NOT_STREAMED:
        with pytest.raises(ValueError, match=flag):
            clean_stream(rows, CleanConfig().on(flag))


# ---- statistics -----------------------------------------------------------


def mention(text):
    import re

    at = text.rfind("@")
    return re.search(r"@+\S{0,30} ", text) is not None or (at > -1 and len(text) - at < 30)


def test_statistics(spark):
    data = dialogs(["hi @bob", "@x y", "plain text", "a" * 40, "", "end@" + "q" * 40], 60, 6, 9)
    got = stats.corpus_statistics(table(spark, data)).first()
    joined = [" ".join(d) for d in data]
    assert got["sessions"] == len(data) and got["multi"] == sum(len(d) > 2 for d in data)
    assert got["have_at"] == sum(mention(j) for j in joined)
    assert got["utterances"] == sum(map(len, data))


def test_statistics_of_nothing(spark):
    got = stats.corpus_statistics(table(spark, [["a"]]).where("false")).first()
    assert got["sessions"] == 0 and got["avg_word"] is None


def test_symbol_census_both_ways(spark, monkeypatch):
    lex = Lexicon.of(spark.createDataFrame([("!", 0), ("?", 1)], "word string, ord long"))
    rows = table(spark, [["a", "b?!"], ["x!"], ["⺀!"], ["none"]])
    want = {"?": 1, "!": 1, "no_emoji": 1}
    assert {r["symbol"]: r["sessions"] for r in stats.symbol_census(rows, lex).collect()} == want
    monkeypatch.setattr(stats, "SYMBOL_CLASS_LIMIT", 0)
    assert {r["symbol"]: r["sessions"] for r in stats.symbol_census(rows, lex).collect()} == want


def test_tokens_helper(spark):
    assert spark.range(1).select(T.tokens(F.lit(" a  b ")).alias("w")).first()["w"] == ["a", "b"]


def test_skew_join_deals_hot_keys(spark, monkeypatch):
    from corpuswash.plans import scale

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(300, "none")], "id long, key string")
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 300, 3)]], "key string, v long")
    want = sorted((i, "hot" if i % 3 else f"k{i}", 1 if i % 3 else i) for i in range(300))
    monkeypatch.setattr(scale, "fits_broadcast", lambda df: False)
    for hot in (10, 1000):
        assert sorted(tuple(r) for r in scale.skew_join(rows, table, ["key"], "inner", ["id"], hot).select("id", "key", "v").collect()) == want
        left = scale.skew_join(rows, table, ["key"], "left", ["id"], hot)
        assert left.count() == 301 and left.where("v is null").count() == 1
