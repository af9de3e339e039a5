"""Phrase mining against plain counting, forced collisions, odd rows."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from corpuswash.llm import phrases

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, most=3, least=10, share=50, top=2000):
    total, f = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    frequent = {x: n for x, n in f.items() if len(x) > 2 and n >= least}
    rows = defaultdict(list)
    for (lang, *w), a in frequent.items():
        longer = [n for (other, *v), n in frequent.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * n >= share * a for n in longer):
            continue
        score, _, l, r = min((Fraction(1000000 * a * a, f[lang, *w[:j]] * f[lang, *w[j:]]).__floor__(), j, f[lang, *w[:j]], f[lang, *w[j:]]) for j in range(1, len(w)))
        rows[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, x in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)}


def made(n=300, seed=3):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ç", "Dd", "dd", "e f", "東京", "g-h", "x y"]
    gaps = [" ", "  ", "\t", ". ", "\n", " , ", "!", "\x0b"]
    docs = [("".join(rng.choice(words[: rng.randint(2, 10)]) + rng.choice(gaps[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None])) for _ in range(n)]
    return docs + [(None, "en"), ("", None), ("   ", "de"), ("..,", "xx"), ("A b " * 200, "und")] + docs[:5] * 3


@pytest.mark.parametrize("most, least, share, top", [(3, 10, 50, 2000), (4, 2, 80, 7), (2, 1, 50, 3)])
def test_equal_to_plain_counting(spark, most, least, share, top):
    docs = made()
    df = spark.createDataFrame([(t, x, "clash", 1, 2) for t, x in docs], "text string, lang string, phrase string, fp int, k int").repartition(5)
    got = phrases.collocations(df, most, least, share, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain(docs, most, least, share, top)


def test_empty_and_wordless_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), (" .", "en")], "text string, lang string")).collect() == []


def test_a_text_longer_than_the_windows():
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", "cde", "F", "g" * 60]) + rng.choice([" ", "\t ", ".", "\n"]) for _ in range(3000))
    whole, cut = phrases.Words.of([text, text]), phrases.Words.of([text, text], window=64)
    for k in (1, 2, 3):
        for x, y in zip(whole.grams(k), cut.grams(k), strict=True):
            assert np.array_equal(x, y)
    assert whole.raw == cut.raw and np.array_equal(whole.starts, cut.starts)


def test_collisions_are_split_by_text(monkeypatch):
    """With fingerprints of three bits nearly all collide; the counts must not change."""
    own = phrases._ranges
    monkeypatch.setattr(phrases, "_ranges", lambda *a: (own(*a) % np.uint64(8)) << np.uint64(61))
    docs = [(t, "en") for t, _ in made(60)]
    full = phrases.Bitmap(16, np.full(1 << 13, 255, np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array([x for _, x in docs]), pa.array([t or "" for t, _ in docs])], ["lang", "text"])
    got = Counter()
    for b in phrases._reading(3, [full] * 3)(iter([batch])):
        for r in b.to_pylist():
            got[r["phrase"]] += r["c"]
    want = Counter()
    for text, _ in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            want.update(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert got == want


def test_large_counts_stay_exact(spark):
    big = 10**12 + 7
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, f long")).first()
    assert got["score"] == 10**6 * (big - 1) ** 2 // (big * (big + 1))


def test_counts_leave_the_task_under_one_number():
    """The language is mixed into the fingerprint: the shuffle adds up by it, without the language's text."""
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"]), pa.array(["a b", "a a"])], ["lang", "text"])
    rows = [r for b in phrases._counting(1, [])(iter([batch])) for r in b.to_pylist()]
    assert all(r.keys() == {"fp", "c"} for r in rows) and sorted(r["c"] for r in rows) == [1, 1, 2]
    assert len({r["fp"] for r in rows}) == 3


def test_texts_of_phrases_are_copied_together():
    """One blank or tab between words: copied as they stand; more blanks and long phrases: joined."""
    words = phrases.Words.of(["A\tb c  d \u00e4\u20ac " + "x" * 2000 + " y", "one. two three"])
    for k in (1, 2, 3):
        first, _ = words.grams(k)
        got = {int(first[i]): x for places, texts in words.texts(first, k) for i, x in zip(places.tolist(), texts.to_pylist(), strict=True)}
        assert got == {i: words.text(i, k).decode() for i in first.tolist()}
