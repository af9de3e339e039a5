"""Column helpers shared by the rules: JVM expressions, and Arrow batches for repeated phrases."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import repeats
from corpuswash.plans import workers


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a variable."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(P.WS_CHARS))


def tight(text: Column) -> Column:
    """The text without its spaces."""
    return F.replace(text, F.lit(" "), F.lit(""))


def tight_len(text: Column) -> Column:
    return F.length(tight(text))


def sub(text: Column, pattern: str, to: str = "") -> Column:
    """Replace every match, then strip."""
    return strip(F.regexp_replace(text, pattern, to))


def tokens(text: Column) -> Column:
    """White-space tokens; an all-blank text has none."""
    return F.filter(F.split(strip(text), f"[{P.WS}]+"), lambda w: w != "")


def grams(text: Column, n: int, step: int = 1) -> Column:
    """Every ``n``-gram that starts at a multiple of ``step``, in one pass.

    ``substring`` walks from the start of the text on each call, so a transform over
    positions is quadratic; a look-ahead match is linear and counts code points.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}})).{{{step}}}"), F.lit(1))


def leads(text: Column, least: int, most: int) -> Column:
    """At every position the next ``most`` characters; positions with fewer than ``least`` left
    are omitted."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{least},{most}}})).{{1}}"), F.lit(1))


def chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def last_at_tail(text: Column) -> Column:
    """Number of characters from the last ``@`` to the end; 0 without an ``@``."""
    return F.when(F.contains(text, F.lit("@")), F.length(F.substring_index(text, "@", -1)) + 1).otherwise(F.lit(0))


def has_mention(text: Column) -> Column:
    """A mention closed by a space, or a last ``@`` close to the end."""
    tail = last_at_tail(text)
    return F.rlike(text, F.lit(P.MENTION)) | ((tail > 0) & (tail < P.MENTION_TAIL))


def drop_mentions(text: Column) -> Column:
    def cut(t: Column) -> Column:
        tail = last_at_tail(t)
        return F.when((tail > 0) & (tail < P.MENTION_TAIL), F.left(t, F.length(t) - tail)).otherwise(t)

    return strip(let(F.regexp_replace(text, P.MENTION, ""), cut))


def drop_literals(text: Column, words: tuple[str, ...]) -> Column:
    for word in words:
        text = F.replace(text, F.lit(word), F.lit(""))
    return text


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def normalise(text: Column) -> Column:
    """Width and quote folding, one line, single spaces, masked mail addresses and phones."""
    text = F.translate(text, P.WIDE_FROM, P.WIDE_TO)
    text = F.regexp_replace(text, P.LINE_BREAKS, " ")
    text = F.regexp_replace(text, P.SPACES, " ")
    text = F.regexp_replace(text, P.EMAIL, P.EMAIL_MASK)
    text = F.regexp_replace(text, P.NORMAL_PHONE, P.PHONE_MASK)
    return strip(text)


def before_title_end(text: Column) -> Column:
    """What stands before the first end of a title; all of it without one."""
    return F.substring_index(text, P.TITLE_END, 1)


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, P.CONTROL, ""), P.BLANKS, " ")


def split_reposts(text: Column) -> Column:
    """Parts of a repost chain; parts after the first get their ``@`` back."""
    parts = F.transform(
        F.split(text, P.REPOST_MARK, -1),
        lambda x, i: let(strip(x), lambda s: F.when((i > 0) & (s != ""), F.concat(F.lit("@"), s)).otherwise(s)),
    )
    return F.when(F.contains(text, F.lit(P.REPOST_MARK)), parts).otherwise(F.array(text))


def mark_votes(parts: Column) -> Column:
    """Parts with their index and a ``vote`` flag: a part whose successor carries the vote
    sentence is flagged together with that successor, scanning from the left."""

    def step(acc: Column, i: Column) -> Column:
        nxt = F.get(parts, i + 1)
        vote = F.coalesce(F.contains(tight(nxt), F.lit(P.VOTE_MARK)), F.lit(False))
        return (
            F.when(acc["skip"], F.struct(F.lit(False).alias("skip"), acc["drop"].alias("drop")))
            .when(
                vote,
                F.struct(F.lit(True).alias("skip"), F.concat(acc["drop"], F.array(i)).alias("drop")),
            )
            .otherwise(acc)
        )

    start = F.struct(F.lit(False).alias("skip"), F.array().cast("array<int>").alias("drop"))
    # the fold returns the index of the first part of every vote pair
    firsts = F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step, lambda acc: acc["drop"])
    return let(
        firsts,
        lambda d: F.transform(
            parts,
            lambda x, i: F.struct(
                i.alias("part"),
                x.alias("text"),
                F.array_contains(d, i).alias("vote"),
                (F.array_contains(d, i) | F.array_contains(d, i - 1)).alias("gone"),
            ),
        ),
    )


# ---- repeated phrases -----------------------------------------------------


def reduce_repeats(text: Column) -> Column:
    """For unit length 1, 2, ... while 4·unit < length: cut more than three repeats to three.

    No unit length is left out; see ``functions/repeats.py``.  A pattern would probe every unit length at every place.
    """
    workers.prepare(SparkSession.active())

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(repeats.reduced, na_action="ignore")

    return cut(text)


def has_repeat(text: Column, times: int, length: int = 2) -> Column:
    """A phrase longer than ``length`` characters that stands ``times`` times in a row."""
    if times < 2:
        raise ValueError("times: 2 or more")
    workers.prepare(SparkSession.active())

    @F.pandas_udf("boolean")
    def test(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: repeats.repeats(t, times, length), na_action="ignore")

    return test(text)


def cap_char_runs(text: Column, no_single: bool = False) -> Column:
    """Cut a character run of seven or more to six and strip the last piece."""
    capped = F.regexp_replace(text, r"(?s)(.)\1{6,}", "$1$1$1$1$1$1")
    # the stripped last piece starts after the last run that ends before the text does
    head = F.regexp_extract(text, r"(?s)^(.*(.)\2{6,}+)(?=.)", 1)
    head_len = F.when(head == "", F.lit(0)).otherwise(
        F.length(F.regexp_replace(head, r"(?s)(.)\1{6,}", "$1$1$1$1$1$1"))
    )
    out = let(
        capped,
        lambda c: F.concat(F.left(c, head_len), strip(F.substring(c, head_len + 1, F.length(c)))),
    )
    if no_single:
        uniform = (F.length(text) > 4) & F.rlike(text, F.lit(r"(?s)^(.)\1*$"))
        out = F.when(uniform, F.lit("")).otherwise(out)
    return out


# ---- word level -----------------------------------------------------------


def too_repetitive(words: Column) -> Column:
    """Few distinct words, or three words that make up more than three quarters.

    With d distinct among n words, d <= n/3 decides at once; otherwise the three most frequent
    can hold over 3/4 only if the other d - 3 words are under n/4, hence only for n < 36.
    """

    def test(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
        )

        def judge(st: Column) -> Column:
            runs = F.transform(st, lambda p, i: F.coalesce(F.get(st, i + 1), n) - p)
            top3 = F.aggregate(F.slice(F.sort_array(runs, False), 1, 3), F.lit(0), lambda a, r: a + r)
            d = F.size(st)
            return (d * 3 <= n) | ((d > 3) & (d < n) & (top3 * 4 > n * 3))

        return (n > 0) & let(starts, judge)

    n = F.size(words)
    few = F.size(F.array_distinct(words)) * 3 <= n
    exact = let(F.sort_array(words), lambda s: F.when(F.size(s) > 0, test(s)).otherwise(F.lit(False)))
    return F.when(n <= 0, F.lit(False)).when(n >= 36, few).otherwise(exact)


# ---- emoji without the keycap characters ----------------------------------


def remove_emoji(text: Column) -> Column:
    """Remove pictographs; unlike the utterance rule this keeps ``*`` and ``#``."""
    return sub(text, f"[{P.PICTOGRAPHS}]+")


def first_emoji(text: Column) -> Column:
    """First pictograph, empty without one."""
    return F.regexp_extract(text, f"[{P.PICTOGRAPHS}]", 0)
