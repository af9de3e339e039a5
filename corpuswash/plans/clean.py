"""The cleaning job: utterances in, cleaned segments and an audit out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.functions import text as T
from corpuswash.model import POSITION, SEGMENT, SESSION, UTTERANCE, known_keys
from corpuswash.operators import blocks as B
from corpuswash.operators import corpus, lexicon, sessions
from corpuswash.operators.lexicon import Lexicon
from corpuswash.operators.rowchain import HIT, apply_rule, apply_rules, explode_hits, hit, prepare
from corpuswash.operators.segmentation import Dictionary, segmented
from corpuswash.operators.rules import BACK_RULES, FINAL_STRIP, FRONT_RULES, TM_RULE, Rule
from corpuswash.plans.config import CleanConfig
from corpuswash.plans.scale import checkpoint, fence, shared, stored, tune


@dataclass(frozen=True)
class Lexicons:
    str_blacklist: Lexicon | None = None
    word_blacklist: Lexicon | None = None
    special_topic: Lexicon | None = None
    name: Lexicon | None = None
    english: Lexicon | None = None
    confuse: Lexicon | None = None


@dataclass(frozen=True)
class Cleaned:
    """``segments`` has one row per surviving turn, keyed by session and ``segment``."""

    segments: DataFrame
    audit: DataFrame | None
    ads: DataFrame | None = None


@dataclass(frozen=True)
class Extensions:
    """User rules run after the built-in utterance rules; ``tokenizer`` replaces white space, and ``dictionary`` cuts
    text written without blanks into words."""

    rules: tuple[Rule, ...] = field(default=())
    tokenizer: Callable[[Column], Column] = T.tokens
    dictionary: Dictionary | None = None


def _chosen(rules: tuple[Rule, ...], cfg: CleanConfig) -> list[Rule]:
    return [r for r in rules if r.flag is None or getattr(cfg, r.flag)]


def _drop_on(rows: DataFrame, word: str, category: str, audit: bool) -> DataFrame:
    """Empty the text where the column ``word`` is set; the word is the audit reason."""
    bad = F.col(word).isNotNull() & (F.col("text") != "")
    if audit:
        rows = _log(rows, bad, hit(F.lit(category), F.col(word)))
    return rows.withColumn("text", F.when(bad, F.lit("")).otherwise(F.col("text")))


def _log(rows: DataFrame, when: Column, entry: Column) -> DataFrame:
    added = F.concat("hits", F.array(entry).cast(f"array<{HIT}>"))
    return rows.withColumn("hits", F.when(when, added).otherwise(F.col("hits")))


#: Flags that need a word list, and the list they need.
NEEDS = {
    "no_special_topic": "special_topic",
    "no_str_blacklist": "str_blacklist",
    "no_alpha_noise": "english",
    "no_word_blacklist": "word_blacklist",
    "check_confuse_word": "confuse",
    "re_name": "name",
}


def require_lexicons(cfg: CleanConfig, lex: Lexicons) -> None:
    """A rule that is on runs, or the job does not start."""
    missing = [f"{flag} needs the lexicon {name}" for flag, name in NEEDS.items() if getattr(cfg, flag) and getattr(lex, name) is None]
    if cfg.check_confuse_word and not cfg.audit:
        missing.append("check_confuse_word only writes audit entries: switch audit on")
    if missing:
        raise ValueError("; ".join(missing))


def clean_utterances(rows: DataFrame, cfg: CleanConfig, lex: Lexicons = Lexicons(), ext: Extensions = Extensions()) -> DataFrame:
    """All utterance and word rules; the result still holds emptied turns, and ``hits`` with audit.

    ``rows`` carry ``block``; every join here is on keys that extend (session, block), so one
    partitioning serves them all.
    """
    require_lexicons(cfg, lex)
    key = [*SESSION, "block", *POSITION]
    rows = apply_rules(prepare(rows, cfg.audit), _chosen(FRONT_RULES, cfg))
    if cfg.joins:
        # the joins read these rows twice each: once for the hits, once to apply them.  Rows that lie by session already
        # keep their place, so there would be no shuffle to read again, and each read would run the rules: they are written
        rows = shared(stored(rows), [*SESSION, "block"])
    if cfg.no_special_topic:
        rows = lexicon.first_contained(rows, T.tight(F.col("orig")), lex.special_topic, "_topic", key)
        rows = _drop_on(rows, "_topic", "special_topic", cfg.audit).drop("_topic")
    if cfg.no_str_blacklist:
        rows = apply_rule(rows, TM_RULE)
        rows = lexicon.remove_substrings(rows, lex.str_blacklist, "_black", key)
        if cfg.audit:
            rows = _log(rows, F.col("_black").isNotNull(), hit(F.lit("str_blacklist"), F.col("_black")))
        rows = rows.drop("_black")
    rows = apply_rules(rows, [*_chosen(BACK_RULES, cfg), *ext.rules, FINAL_STRIP])
    if cfg.word_level:
        if cfg.joins:
            rows = shared(stored(rows), [*SESSION, "block"])
        rows = _word_level(rows, cfg, lex, ext, key)
    return fence(rows, ["text", "hits"] if cfg.audit else ["text"])


def _word_level(rows: DataFrame, cfg: CleanConfig, lex: Lexicons, ext: Extensions, key: list[str]) -> DataFrame:
    if ext.dictionary is not None:
        rows = segmented(rows, F.col("text"), ext.dictionary, "_w", key)
    else:
        rows = rows.withColumn("_w", ext.tokenizer(F.col("text")))
    rows = rows.withColumn("text", F.array_join("_w", " "))
    english = lex.english if cfg.no_alpha_noise else None
    black = lex.word_blacklist if cfg.no_word_blacklist else None
    if english is not None or black is not None:
        facts = lexicon.word_facts(rows, F.col("_w"), key, english, black)
        rows = rows.join(facts, key, "left")
    if english is not None:
        rows = _drop_on(rows, "noise_word", "not_en", cfg.audit)
    if cfg.check_confuse_word:
        rows = lexicon.confused_tokens(rows, F.col("_w"), lex.confuse, "_confused", key)
        found = F.col("_confused").isNotNull() & (F.col("text") != "")
        rows = _log(rows, found, hit(F.lit("confuse"), F.col("_confused"))).drop("_confused")
    if black is not None:
        rows = _drop_on(rows, "black_token", "word_blacklist", cfg.audit)
    if cfg.yda_dedupl:
        rows = rows.withColumn("_yda", F.when(T.too_repetitive(F.col("_w")), F.lit("yda")))
        rows = _drop_on(rows, "_yda", "duplicated", cfg.audit)
    return rows.drop("_w", "_yda", "noise_word", "black_token")


def clean(
    utterances: DataFrame,
    cfg: CleanConfig,
    lex: Lexicons = Lexicons(),
    ext: Extensions = Extensions(),
    materialize: bool | None = None,
) -> Cleaned:
    """Run the whole job.

    ``materialize`` checkpoints the cleaned utterances once, so that writing the segments,
    writing the audit and the later passes do not each run the rules.  By default this happens
    when a name or corpus pass is on: those read the utterances more than once.
    """
    require_lexicons(cfg, lex)
    tune(utterances.sparkSession)
    rows = known_keys(utterances)
    long = B.is_long(rows, cfg.block_turns)
    rows = B.with_block(rows, cfg.block_turns)
    side: list[DataFrame] = []
    if cfg.no_utter_dup:
        rows, log = sessions.drop_uniform(rows, long)
        side.append(log)
    if cfg.split_multi_repost:
        rows, log = sessions.split_parts(rows, cfg.no_toupiao)
        if cfg.no_toupiao:
            side.append(log)
    rows = clean_utterances(rows, cfg, lex, ext)
    if materialize or (materialize is None and cfg.later_passes):
        rows = checkpoint(rows)
    audit = None
    if cfg.audit:
        audit = explode_hits(rows)
        for log in side:
            audit = audit.unionByName(log)
    turns = rows.select(*UTTERANCE, "block", "text")
    if cfg.re_name:
        turns = sessions.rename_names(turns, lex.name, long)
    segments = sessions.segment(turns, long, cfg.no_short_response, cfg.min_turns)
    if cfg.no_ad or cfg.de_generic_dialog:
        segments = stored(segments)  # the corpus passes read them several times
    ads = None
    if cfg.no_ad:
        ads = checkpoint(
            corpus.ad_responses(segments, long, SEGMENT, cfg.scope, cfg.ad_min_len, cfg.ad_min_contexts)
        )
        segments = corpus.cut_ads(segments, ads, long, SEGMENT, cfg.scope)
        if cfg.de_generic_dialog:
            segments = stored(segments)
    if cfg.de_generic_dialog:
        counts = corpus.trigram_counts(segments, cfg.scope, SEGMENT, long)
        generic = checkpoint(corpus.generic_trigrams(counts, cfg.generic_min_count))
        if audit is not None:
            met = corpus.generic_hits(segments, generic, long, SEGMENT, cfg.scope)
            log = sessions.audit_rows(met, "generic", "generic").withColumn("reason", F.col("before"))
            audit = audit.unionByName(log)
        segments = corpus.cut_generic(segments, generic, long, SEGMENT, cfg.scope)
    return Cleaned(segments.select(*SEGMENT, "turn", "part", "text"), audit, ads)
