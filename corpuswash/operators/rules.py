"""The utterance rules, declared once and folded into a plan by the row chain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import text as T


@dataclass(frozen=True)
class Context:
    """Columns a rule may look at besides the current text."""

    orig: Column
    tight: Column
    file_id: Column


@dataclass(frozen=True)
class Rule:
    """``edit`` rules return the new text, ``drop`` rules a Boolean.

    ``audit`` says what is logged on a hit: the original utterance (``orig``), the text before
    and after (``pair``), the first emoji run and the original (``emoji``), or nothing.
    """

    id: str
    flag: str | None
    kind: str
    category: str
    reason: str
    fn: Callable[[Column, Context], Column]
    audit: str = "orig"


def _edit(pattern: str, to: str = "") -> Callable[[Column, Context], Column]:
    return lambda t, c: T.sub(t, pattern, to)


def _brackets(t: Column, c: Context) -> Column:
    wide = T.sub(t, P.BRACKETS_WIDE)
    return F.when(T.contains_any(c.file_id, P.BRACKET_SOURCES), T.sub(wide, P.BRACKETS)).otherwise(wide)


def _showall(t: Column, c: Context) -> Column:
    return F.when(T.contains_any(c.file_id, P.SHOWALL_SOURCES), T.sub(t, P.SHOW_ALL)).otherwise(t)


# execution order; None as flag means always on
FRONT_RULES: tuple[Rule, ...] = (
    Rule("B0", None, "edit", "", "", lambda t, c: F.replace(T.strip(t), F.lit(P.LINK_MARK), F.lit("")), "none"),
    Rule("B1", None, "edit", "other", P.COMMENT_MARK, lambda t, c: F.substring_index(t, P.COMMENT_MARK, 1)),
    Rule("C1", "no_specific_utter", "drop", "other", "specific_utter", lambda t, c: c.tight.isin(*P.NO_SPECIFIC)),
    Rule("B2", "de_reply_tag", "edit", "other", "de_reply_tag", _edit(P.REPLY)),
    Rule("B3", "de_angle", "edit", "other", "angle", _edit(P.ANGLE)),
    Rule("B4", "de_url", "edit", "other", "url", _edit(P.URL, " ")),
    Rule("B5", "de_weibo_url", "edit", "other", "weibo_url", _edit(P.WEIBO_URL, " ")),
    Rule("B6", "de_brackets", "edit", "emoji", "weibo_emoji", _brackets),
    Rule("B26", "de_lenticular", "edit", "emoji", "lenticular", _edit(P.BRACKETS_LENTICULAR)),
    Rule("B7", "de_hashtag", "edit", "emoji", "hashtag", _edit(P.HASHTAG)),
    Rule("B8", "de_emotion", "edit", "emoji", "emotion", _edit(P.EMOTION)),
    Rule("B9", "de_html", "edit", "emoji", "html", _edit(P.HTML), "pair"),
    Rule("C2", "no_mention", "drop", "other", "mention", lambda t, c: T.has_mention(t)),
    Rule("B10", "de_mention", "edit", "emoji", "no_at", lambda t, c: T.drop_mentions(t)),
    Rule("B11", "de_single_repost_mention", "edit", "emoji", "single_repost", _edit(P.SINGLE_REPOST)),
    Rule("B12", "de_repost", "edit", "emoji", "repost_mention", _edit(P.REPOST)),
    Rule("B13", "de_showall", "edit", "other", "showall", _showall),
    Rule("B14", "de_emoji", "edit", "emoji", "emoji", _edit(P.EMOJI), "emoji"),
    Rule("B16", "de_alpha_num", "edit", "other", "de_alpha_num", _edit(P.ALPHA_NUM, " ")),
    Rule("B17", "de_specific", "edit", "other", "de_specific", lambda t, c: T.drop_literals(t, P.DE_SPECIFIC)),
    Rule("B18", "de_phone", "edit", "other", "de_phone", _edit(P.PHONE, P.PHONE_MASK), "pair"),
    Rule("B19", "de_qq", "edit", "other", "de_qq", _edit(P.QQ, " "), "pair"),
    Rule("B20", "cleantext_clean", "edit", "other", "cleantext", lambda t, c: T.normalise(t), "pair"),
    Rule("B21", "bert_clean", "edit", "other", "bert_clean", lambda t, c: T.drop_controls(t), "pair"),
    Rule("B15", "de_emoji", "edit", "", "", _edit(P.COLON), "none"),
    Rule("C3", "contain_zh", "drop", "other", "contain_zh", lambda t, c: ~F.rlike(t, F.lit(P.CJK))),
)

# between the lexicon steps and the word level
BACK_RULES: tuple[Rule, ...] = (
    Rule("B23", "de_duplicated", "edit", "other", "de_duplicated", lambda t, c: T.reduce_repeats(t)),
    Rule("C5", "no_short", "drop", "other", "short", lambda t, c: T.tight_len(t) < P.SHORT_LEN),
    Rule("C6", "no_long", "drop", "other", "long", lambda t, c: T.tight_len(t) > P.LONG_LEN),
)

TM_RULE = Rule(
    "B22", "no_str_blacklist", "edit", "", "", lambda t, c: F.regexp_replace(t, P.TM, "$1$3"), "none"
)
FINAL_STRIP = Rule("B0", None, "edit", "", "", lambda t, c: T.strip(t), "none")

RULES: dict[str, Rule] = {r.id: r for r in (*FRONT_RULES, TM_RULE, *BACK_RULES)}
