"""Golden rows and randomised checks of the utterance rules."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import repeats
from corpuswash.functions import text as T
from corpuswash.operators.rowchain import apply_named

GOLDEN = [
    ("B0", "  alink hi　", " hi"),
    ("B1", "good ¡ 评论 12", "good "),
    ("C1", "转 发", ""),
    ("B2", "回复 @Devid: 我会准时到的", "我会准时到的"),
    ("B3", "<angle> x <中文>", "x <中文>"),
    ("B4", "卍(www.suzastampin.com)卡尔", "卍( )卡尔"),
    ("B4", "http://10.0.0.1/x", "http://10.0.0.1/x"),
    ("B4", "HTTP://中文.com/", "HTTP://中文.com/"),
    ("B4", "see https://a-b.example.com:8080/p?q=1 ok", "see   ok"),
    ("B5", "x http://t.cn/AbC1 y", "x   y"),
    ("B6", "［酷］ [doge] a", "a"),
    ("B7", "#tag# hi #no", "hi #no"),
    ("B8", ":smile: hi", "hi"),
    ("B9", "<b>x y <br /> z", "y  z"),
    ("C2", "hi @bob there", ""),
    ("C2", "hello", "hello"),
    ("B10", "hello", "hello"),
    ("B10", "@amy hi @bob", "hi"),
    ("B11", "@Cindy : hi", "hi"),
    ("B12", "hi //@Bob: 算我一个\nnext", "hi \nnext"),
    ("B13", "abc… 显示全部 ", "abc"),
    ("B14", "🐹a*b#c", "abc"),
    ("B15", "a :::: b", "ab"),
    ("B16", "哈哈 sda83daj.jp 哈哈", "哈哈 哈哈"),
    ("B17", "[图片]a{ }b我擦​", "ab"),
    ("B18", "x13800138000y z", "</PHONE>z"),
    ("B18", "call 13800138000 now", "call 13800138000 now"),
    ("B19", "QQ12345678, hi", "hi"),
    ("B20", "🐹你要认真拍，胶片很珍贵", "🐹你要认真拍,胶片很珍贵"),
    ("B20", "a.b@mail.example.com，“+86 138-0013-8000”", "</EMAIL>,\"</PHONE>\""),
    ("B21", "a\u0007b c\td�", "ab c d"),
    ("B22", "谁tM跟你在Tm一起了", "谁跟你在一起了"),
    ("B23", "aaaa", "aaaa"),
    ("B23", "aaaaa", "aaa"),
    ("B23", "cbababababababacacacacbacbbbabbb", "cbababacacacbacbbbabbb"),
    ("B26", "【广告】 x", "x"),
    ("C3", "abc", ""),
    ("C3", "abc你", "abc你"),
    ("C5", " a ", ""),
    ("C6", "x" * 1001, ""),
]


def column(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string").repartition(4)
    rows = df.select("i", fn(F.col("text")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


def test_golden_rows(spark):
    rows = [("d", "weibo_tang_zhihu", i, 0, 0, t) for i, (_, t, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "dataset string, file_id string, session_id long, turn long, part int, text string")
    for rid in sorted({g[0] for g in GOLDEN}):
        wanted = {i: out for i, (r, _, out) in enumerate(GOLDEN) if r == rid}
        got = {r["session_id"]: r["text"] for r in apply_named(df.where(F.col("session_id").isin(*wanted)), rid).collect()}
        assert got == wanted, rid


def randoms(alphabet, n, length, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, length))) for _ in range(n)]


# fixed values: the plain forms of the rules' patterns
@pytest.mark.parametrize(
    "pattern, plain, alphabet",
    [
        (P.REPOST, r"/ ?/? ?@ ?(?:[\w \-] ?){,30}? ?:.+", "/@: a-\n"),
        (P.SINGLE_REPOST, r"(@+)(\S*?\s*?): *", "@: ab\n"),
        (P.HTML, r"<(.)>.?|<(.*) />", "<>/ ab\n"),
        (P.TM, r"(?i)([^a-zA-Z])(tm)([^a-zA-Z])", "tTmM a"),
    ],
)
def test_rewritten_patterns_match_the_plain_ones(spark, pattern, plain, alphabet):
    texts = randoms(alphabet, 1500, 24, 7) + ["/@" + "a " * 40 + ":x", "/@" + "ab" * 15 + ":x", "/@" + " " * 33 + ":x"]
    got = column(spark, texts, lambda t: F.regexp_replace(t, pattern, ""))
    assert got == [re.sub(plain, "", t) for t in texts]


def cut_repeats(text):
    """Unit lengths in rising order; wherever four or more equal units begin, three stay."""
    for unit in itertools.count(1):
        if 4 * unit >= len(text):
            return text
        run, begin = re.compile(r"(?s)(?=((.{%d})\2{3,}))" % unit), 0
        while found := run.search(text, begin):
            begin = found.start() + 1
            text = text[: found.start(1)] + 3 * found[2] + text[found.end(1) :]


def test_repeats_against_a_scan(spark):
    texts = randoms("ab", 300, 40, 1) + randoms("abc", 300, 60, 2)
    rnd = random.Random(3)
    for _ in range(40):
        unit = "".join(rnd.choice("abcdefghij ") for _ in range(rnd.randint(15, 60)))
        texts.append(randoms("xyz", 1, 50, rnd.random())[0] + unit * rnd.randint(2, 7) + randoms("xyz", 1, 50, rnd.random())[0])
    assert column(spark, texts, T.reduce_repeats) == [cut_repeats(t) for t in texts]


def test_has_repeat(spark):
    texts = randoms("ab", 200, 40, 4) + ["abcabcabcabc", "abcdefgh" * 4, ""]
    want = [re.search(r"(?s)(.{3,})\1{3}", t) is not None for t in texts]
    assert column(spark, texts, lambda t: T.has_repeat(t, 4)) == want


def test_cap_char_runs(spark):
    texts = ["aaaaaaaaab  ", "aaaaaaa", " aaaaaaa ", "abc ", "aaaaa", "", "x" + "b" * 9 + " c "]
    want = ["aaaaaab", "aaaaaa", " aaaaaa", "abc", "aaaaa", "", "xbbbbbbc"]
    assert column(spark, texts, T.cap_char_runs) == want
    assert column(spark, ["aaaaa", "aaaa", "ab"], lambda t: T.cap_char_runs(t, no_single=True)) == ["", "aaaa", "ab"]


def test_long_texts_do_not_break_the_regex_engine(spark):
    texts = ["http://" + "a" * 50000, "http://" + "a." * 20000, "a" * 50000 + "@", "/@" + " " * 200, "<" * 3000]
    for fn in (lambda t: T.sub(t, P.URL, " "), T.normalise, lambda t: T.sub(t, P.REPOST)):
        assert len(column(spark, texts, fn)) == len(texts)


def test_white_space_is_the_unicode_set(spark):
    assert column(spark, ["　\x1c a  "], T.strip) == ["a"]
    assert column(spark, ["a　b\x1dc"], T.tokens) == [["a", "b", "c"]]


def judge(words):
    """A third or less of the words are different, or - with repeats and over three of them - three make over 3/4."""
    times = Counter(words)
    few = 0 < len(words) >= 3 * len(times)
    top = sum(n for _, n in times.most_common(3))
    return few or (len(times) > 3 and max(times.values()) > 1 and 4 * top > 3 * len(words))


def test_word_repetition(spark):
    texts = [" ".join(t) for t in randoms("abcdef", 300, 14, 5)] + [""]
    assert column(spark, texts, lambda t: T.too_repetitive(T.tokens(t))) == [judge(t.split()) for t in texts]


def test_vote_pairs(spark):
    vote = "你也快来表态吧"
    texts = [f"a//@b//@{vote}", f"a//@{vote}//@{vote}//@c", "a", vote, f"a//@b{vote}//@c//@d {vote}//@e"]
    got = column(spark, texts, lambda t: F.filter(T.mark_votes(T.split_reposts(t)), lambda m: ~m["gone"]))
    assert [[m["text"] for m in row] for row in got] == [["a"], [f"@{vote}", "@c"], ["a"], [vote], ["@e"]]


def test_repeats_of_every_unit_in_small_steps(monkeypatch):
    rng = random.Random(6)
    texts = []
    for k in range(600):
        t = "".join(rng.choice("ab" if k % 2 else "abc🐹") for _ in range(rng.randint(0, 16)))
        texts.append("".join(rng.choice([t[:3], t[2:9], "x"]) * rng.randint(1, 6) for _ in range(8)))
    for step in (2_000_000, 7):
        monkeypatch.setattr(repeats, "STEP", step)
        for t in texts:
            assert repeats.reduced(t) == cut_repeats(t)
            for times, least in ((2, 0), (3, 1), (4, 2), (6, 0)):
                want = any(re.search(r"(?s)(.{%d})\1{%d}" % (u, times - 1), t) for u in range(least + 1, len(t) // times + 1))
                assert repeats.repeats(t, times, least) == want


def test_repeats_of_null_and_long_texts(spark):
    texts = [None, "", "a" * 300_000, "abcdefghij" * 50_000, "xy" * 100_000 + "z"]
    assert column(spark, texts, T.reduce_repeats) == [None, "", "aaa", "abcdefghij" * 3, "xyxyxyz"]
    assert column(spark, texts, lambda t: T.has_repeat(t, 4)) == [None, False, True, True, True]
