"""Lexicons and everything that matches text or tokens against them.

Substring matching hashes every position of the texts inside the scan and keeps those at which a word may begin (a Bloom
filter over the words' beginnings tells); these are equi-joined with the lexicon, and whole words are compared.  A position
costs the same however many words the lexicon has and however long they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import places
from corpuswash.functions import text as T
from corpuswash.model import UTTERANCE
from corpuswash.plans import workers
from corpuswash.plans.scale import BROADCAST_BYTES, BROADCAST_ROWS, SALTS, by_frequency, checkpoint, lookup_join, stored

# words are joined on 4 to 8 leading characters, as many as the shortest word allows
PREFIX_MIN = 4
PREFIX_MAX = 8
# characters that a place carries
AHEAD = 256
INLINE_WORDS = 64


@dataclass(frozen=True)
class Lexicon:
    """A word list ``(word, ord)`` together with its measured size."""

    df: DataFrame
    rows: int
    size: int
    max_len: int
    prefix_lens: tuple[int, ...]

    @staticmethod
    def of(words: DataFrame, word: str = "word", ord: str | None = "ord", first: int | None = None) -> Lexicon:
        """Strip, drop blanks, keep the first position of each word, store and measure.

        ``first`` keeps that many non-blank entries from the head of the list.  A word list is
        read by several joins, so it is written once to the checkpoint folder.
        """
        order = F.col(ord) if ord else F.monotonically_increasing_id()
        df = words.select(T.strip(F.col(word)).alias("word"), order.cast("long").alias("ord")).where("word != ''")
        if first is not None:
            df = df.orderBy("ord").limit(first)
        df = checkpoint(df.groupBy("word").agg(F.min("ord").alias("ord")))
        n = F.length("word")
        m = df.agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(F.octet_length("word") + 72), F.lit(0)).alias("size"),
            F.coalesce(F.max(n), F.lit(0)).alias("max_len"),
            F.collect_set(F.least(n, F.lit(PREFIX_MAX))).alias("lens"),
        ).first()
        k = max(PREFIX_MIN, min(m["lens"], default=0))
        return Lexicon(df, m["rows"], m["size"], m["max_len"], tuple(sorted({min(x, k) for x in m["lens"]})))

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES

    def join(self, rows: DataFrame, on: str, how: str, salt_by: list[str], table: DataFrame | None = None) -> DataFrame:
        """Join rows with the lexicon (or a table derived from it): broadcast when it was
        measured small, otherwise shuffled with the hot keys salted."""
        table = self.df if table is None else table
        if self.small:
            return rows.join(F.broadcast(table), on, how)
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
        spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return salted.join(spread, [on, "_salt"], how).drop("_salt")

    def inline(self) -> list[str] | None:
        """The words in order when there are few enough to write them into an expression."""
        if self.rows > INLINE_WORDS:
            return None
        return [r["word"] for r in self.df.orderBy("ord").collect()]


def _filter(strings: DataFrame, rows: int, lens: tuple[int, ...]) -> places.Beginnings:
    """The Bloom filter over a column of strings: 32 MiB at most reach the driver, however many there are."""
    bits = places.Beginnings.bits_for(rows)
    marks = strings.distinct().mapInArrow(places.marked(bits), "part long, bit long")
    data = np.zeros(max(places.PART, 1 << bits) // 8, np.uint8)
    for r in marks.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("map")).collect():
        data[r["part"] * (places.PART // 8) :][: places.PART // 8] = np.frombuffer(r["map"], np.uint8)
    return places.Beginnings(bits, data, lens)


def beginnings(lexicon: Lexicon) -> places.Beginnings:
    """The Bloom filter over the words' beginnings."""
    k = max(lexicon.prefix_lens)
    return _filter(lexicon.df.select(F.left("word", F.lit(k)).alias("head")), lexicon.rows, lexicon.prefix_lens)


def whole_words(lexicon: Lexicon) -> places.Beginnings:
    """The Bloom filter over the words themselves, as far as a place carries them."""
    heads = lexicon.df.select(F.left("word", F.lit(AHEAD)).alias("head"))
    lens = heads.select(F.length("head").alias("n")).distinct().collect()
    return _filter(heads, lexicon.rows, tuple(sorted(r["n"] for r in lens)))


def substring_hits(rows: DataFrame, text: Column, lexicon: Lexicon, key: list[str]) -> DataFrame:
    """Every occurrence ``(key, end, len, word, ord)`` of a lexicon word; ``end`` counts from 0.

    A place leaves the scan only if its first characters may begin a word, and carries at most ``AHEAD`` characters.
    Words are compared after the join on their beginning; longer ones are compared once more with the text itself.
    With a list too long to broadcast, a place is shuffled only if a whole word may stand there, with that word alone.
    """
    keyed = rows.select(*key, F.coalesce(text, F.lit("")).alias("_t"))
    if lexicon.rows == 0:
        return keyed.where(F.lit(False)).select(
            *key, F.lit(0).alias("end"), F.lit(0).alias("len"), F.lit("").alias("word"), F.lit(0).cast("long").alias("ord")
        )
    spark = rows.sparkSession
    workers.prepare(spark)
    sent = spark.sparkContext.broadcast((beginnings(lexicon), None if lexicon.small else whole_words(lexicon)))
    ahead = min(AHEAD, lexicon.max_len)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:-1])
    at = keyed.mapInArrow(lambda b: places.candidates(sent.value[0], ahead, sent.value[1])(b), f"{kinds}, n int, at int, ahead string")
    table = lexicon.df.select("word", "ord", F.length("word").alias("len"))
    if lexicon.small:
        k = max(lexicon.prefix_lens)
        found = at.withColumn("prefix", F.left("ahead", "n")).join(F.broadcast(table.withColumn("prefix", F.left("word", F.lit(k)))), "prefix")
    else:  # a frequent word is one large partition of the places, which Spark splits
        found = at.drop("n").join(table.withColumn("ahead", F.left("word", F.lit(AHEAD))), "ahead")
    if lexicon.max_len > AHEAD:
        found = found.where(F.startswith("ahead", F.left("word", F.lit(AHEAD))))
        long = found.where(F.col("len") > AHEAD).join(keyed, key)
        long = long.where(F.substring("_t", F.col("at") + 1, F.col("len")) == F.col("word"))
        found = found.where(F.col("len") <= AHEAD).unionByName(long.drop("_t"))
    else:
        found = found.where(F.startswith("ahead", "word"))
    return found.select(*key, (F.col("at") + F.col("len") - 1).alias("end"), "len", "word", "ord")


def first_contained(rows: DataFrame, text: Column, lexicon: Lexicon, out: str, key: list[str]) -> DataFrame:
    """Add the contained lexicon word that comes first in the list, or null.

    A short list becomes an expression; a long one goes through the substring join.
    """
    words = lexicon.inline()
    if words is not None:
        hits = [F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]
        return rows.withColumn(out, F.coalesce(*hits) if hits else F.lit(None).cast("string"))
    hits = substring_hits(rows, text, lexicon, key)
    first = hits.groupBy(*key).agg(F.min_by("word", "ord").alias(out))
    return rows.join(first, key, "left")


def contained_words(rows: DataFrame, text: Column, lexicon: Lexicon, key: list[str]) -> DataFrame:
    """All lexicon words an utterance contains, in list order: ``(key, words)``."""
    hits = substring_hits(rows, text, lexicon, key).select(*key, "ord", "word").distinct()
    listed = F.array_sort(F.collect_list(F.struct("ord", "word")))
    return hits.groupBy(*key).agg(F.transform(listed, lambda h: h["word"]).alias("words"))


def last_alternation(rows: DataFrame, text: Column, lexicon: Lexicon, out: str, key: list[str]) -> DataFrame:
    """Add the last hit of an alternation of all words, or null.

    As a pattern does, hits are taken from the left, at equal places in list order, and without
    overlap.  The places come from the substring join, so the list may have any length.
    """
    hits = substring_hits(rows, text, lexicon, key).withColumn("at", F.col("end") - F.col("len") + 1)
    heads = hits.groupBy(*key, "at").agg(F.min_by(F.struct("len", "word"), "ord").alias("w"))
    listed = heads.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("at", "w.len", "w.word"))).alias("_h"))
    start = F.struct(F.lit(0).alias("free"), F.lit(None).cast("string").alias("word"))

    def step(acc: Column, h: Column) -> Column:
        taken = F.struct((h["at"] + h["len"]).alias("free"), h["word"].alias("word"))
        return F.when(h["at"] >= acc["free"], taken).otherwise(acc)

    last = listed.select(*key, F.aggregate("_h", start, step, lambda a: a["word"]).alias(out))
    return rows.join(last, key, "left")


def removal_lists(rows: DataFrame, text: Column, lexicon: Lexicon, key: list[str]) -> DataFrame:
    """Hits per utterance by end position, longest first: ``(key, words)``."""
    hits = substring_hits(rows, text, lexicon, key)
    ordered = F.array_sort(F.collect_list(F.struct("end", (-F.col("len")).alias("n"), "word")))
    return hits.groupBy(*key).agg(F.transform(ordered, lambda h: h["word"]).alias("words"))


def remove_words(text: Column, words: Column) -> Column:
    """Delete the words one after the other, each wherever it stands at that moment.

    Words found absent are not looked for again until the text changes, so a text is read about once per different word
    and change instead of once per hit.  (Taking a word out may bring it forth again: a change empties the list.)
    """
    none = F.array().cast("array<string>")

    def step(acc: Column, w: Column) -> Column:
        def cut(shorter: Column) -> Column:
            same = F.octet_length(shorter) == F.octet_length(acc["text"])
            absent = F.when(same, F.array_append(acc["absent"], w)).otherwise(none)
            return F.struct(shorter.alias("text"), absent.alias("absent"))

        return F.when(F.array_contains(acc["absent"], w), acc).otherwise(T.let(F.replace(acc["text"], w, F.lit("")), cut))

    start = F.struct(text.alias("text"), none.alias("absent"))
    return F.aggregate(words, start, step, lambda a: a["text"])


def remove_substrings(rows: DataFrame, lexicon: Lexicon, out: str = "black_word", key: list[str] | None = None) -> DataFrame:
    """Remove every lexicon hit from ``text``; ``out`` is the last hit, null without one."""
    key = key or UTTERANCE
    lists = removal_lists(rows, F.col("text"), lexicon, key)
    joined = rows.join(lists, key, "left")
    clean = F.when(F.col("words").isNotNull(), remove_words(F.col("text"), F.col("words"))).otherwise(F.col("text"))
    last = F.try_element_at("words", F.lit(-1))
    keep = [c for c in rows.columns if c != "text"]
    return joined.select(*keep, clean.alias("text"), last.alias(out)).select(*rows.columns, out)


# ---- word level -----------------------------------------------------------


def word_facts(
    rows: DataFrame,
    words: Column,
    key: list[str],
    english: Lexicon | None = None,
    blacklist: Lexicon | None = None,
) -> DataFrame:
    """First noise token and first blacklisted token of each utterance that has one.

    A noise token is made of ASCII letters only and is neither an English word (compared in
    lower case) nor one of the tolerated short tokens.
    """
    placed = rows.select(*key, F.posexplode(words).alias("pos", "word"))
    parts = []
    if english is not None:
        letters = placed.where(F.rlike("word", F.lit("^[A-Za-z]+$")) & ~F.col("word").isin(*P.ENGLISH_EXTRA))
        letters = letters.withColumn("lower", F.lower("word"))
        known = english.df.select(F.lower("word").alias("lower")).distinct()
        noise = english.join(letters, "lower", "left_anti", [*key, "pos"], known) if english.small else _not_in(letters, known, key)
        parts.append(noise.select(*key, "pos", "word", F.lit("noise").alias("kind")))
    if blacklist is not None:
        bad = blacklist.join(placed, "word", "left_semi", [*key, "pos"])
        parts.append(bad.select(*key, "pos", "word", F.lit("black").alias("kind")))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def first(kind: str) -> Column:
        return F.min_by("word", F.when(F.col("kind") == kind, F.col("pos")))

    return both.groupBy(*key).agg(first("noise").alias("noise_word"), first("black").alias("black_token"))


def _not_in(letters: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """First token ``(key, pos, word)`` of each utterance, and some later ones, that a list too long to broadcast lacks.

    The vocabulary is compared with the list once.  Its frequent words decide where the tokens stand; of the others each
    utterance sends a word once.
    """
    listed = known.withColumn("known", F.lit(True))
    vocabulary = letters.groupBy("lower").agg(F.count("*").alias("n")).join(listed, "lower", "left")
    often, seldom = by_frequency(stored(vocabulary.withColumn("known", F.coalesce("known", F.lit(False)))), "n")
    marked = letters.join(F.broadcast(often.select("lower", "known")), "lower", "left").where("known IS NULL OR NOT known")
    first = F.min(F.struct("pos", "word")).alias("_f")
    open_ = stored(marked.groupBy(*key, F.when(F.col("known").isNull(), F.col("lower")).alias("_seldom")).agg(first))
    rare = open_.join(seldom.where("NOT known").select(F.col("lower").alias("_seldom")), "_seldom", "left_semi")
    return open_.where("_seldom IS NULL").unionByName(rare).select(*key, "_f.pos", "_f.word")


def confused_token(words: Column, lexicon: Lexicon) -> Column:
    """First token that contains a confusable string; for lists short enough to inline."""
    known = lexicon.inline()
    if known is None:
        raise ValueError("use confused_tokens for a long list")
    if not known:
        return F.lit(None).cast("string")
    return F.try_element_at(F.filter(words, lambda w: T.contains_any(w, tuple(known))), F.lit(1))


def confused_tokens(rows: DataFrame, words: Column, lexicon: Lexicon, out: str, key: list[str]) -> DataFrame:
    """Add the first token that contains a confusable string, or null.

    Every different token is searched once.
    """
    if lexicon.rows <= INLINE_WORDS:
        return rows.withColumn(out, confused_token(words, lexicon))
    placed = rows.select(*key, F.posexplode(words).alias("pos", "token"))
    found = stored(substring_hits(placed.select("token").distinct(), F.col("token"), lexicon, ["token"]).select("token").distinct())
    hits = lookup_join(placed, found, ["token"], "left_semi", [*key, "pos"])
    first = hits.groupBy(*key).agg(F.min_by("token", "pos").alias(out))
    return rows.join(first, key, "left")


