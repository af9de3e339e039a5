"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import text as T
from corpuswash.model import SEGMENT, SESSION, UTTERANCE, to_utterances
from corpuswash.operators import audit as A
from corpuswash.operators import blocks as B
from corpuswash.operators import classify, corpus, lexicon, segmentation, sessions, stats
from corpuswash.operators.lexicon import Lexicon
from corpuswash.operators.rowchain import apply_named
from corpuswash.operators.rules import RULES
from corpuswash.plans.clean import Lexicons, clean
from corpuswash.plans.config import CleanConfig
from corpuswash.plans import scale
from corpuswash.plans.scale import checkpoint, tune
from corpuswash.sources import readers, writers
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["dataset", "file_id", "session_id", "turn"]
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
GENERIC_MIN = 20


def _u(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    return inputs.utterances(spark, sf)


def _t(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    tune(spark)
    rows = inputs.threads(spark, sf)
    long = B.is_long(rows)
    return B.with_block(rows), long


# ---- lexicons made from the tables ----------------------------------------


def _words(spark: SparkSession, sf: str, table: str, pattern: str, where: str = "true", lower: bool = True, cond: str = "true", ranked: bool = False) -> DataFrame:
    """Distinct tokens of a table.  ``ord`` is the alphabetical place for lists whose order
    matters; these come from the small ``benchmark`` table, others are not ranked."""
    df = spark.read.parquet(f"{sf}/{table}.parquet").where(cond)
    w = df.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("w")).where(where)
    d = w.select((F.lower("w") if lower else F.col("w")).alias("word")).distinct()
    if not ranked:
        return d.select("word", F.lit(0).cast("long").alias("ord"))
    return scale.ranked(d, ["word"], "ord")


def black(spark: SparkSession, sf: str, first: int | None = None) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "benchmark", LETTERS + "{6,}", ranked=True), first=first)


def topics(spark: SparkSession, sf: str) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "benchmark", LETTERS + "{9,}", ranked=True))


def names(spark: SparkSession, sf: str) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "benchmark", f"[^{P.WS}]+", lower=False))


def bad_tokens(spark: SparkSession, sf: str) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "benchmark", f"[^{P.WS}]+", "length(w) >= 9", lower=False))


def english(spark: SparkSession, sf: str) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "documents", "[A-Za-z]+", cond="lang = 'en'"))


def large(spark: SparkSession, sf: str) -> Lexicon:
    """Every long word of the documents: over 110 000 from sf0.1 on."""
    return Lexicon.of(_words(spark, sf, "documents", LETTERS + "{9,}"))


def confusables(spark: SparkSession, sf: str) -> Lexicon:
    """Capitalised words.  Topics and blacklist are in lower case, so the rules before the word level leave these standing."""
    return Lexicon.of(_words(spark, sf, "benchmark", "[A-Z][a-z]{4,}", lower=False, ranked=True))


def symbols(spark: SparkSession, sf: str) -> Lexicon:
    return Lexicon.of(_words(spark, sf, "documents", r"[^A-Za-z0-9 \n]", lower=False))


# ---- queries --------------------------------------------------------------


def _rule(rid: str) -> Query:
    return lambda spark, sf: apply_named(_u(spark, sf), rid).select(*KEYS, "text")


def _folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    spark.range(0).transform(checkpoint)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def dialogue_files(spark: SparkSession, sf: str) -> DataFrame:
    """Dialogues written as JSON lines, one compressed, and read back from the tree."""
    tune(spark)
    chats = spark.read.parquet(f"{sf}/conversations.parquet")
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    lines = chats.groupBy("conv_id").agg(F.to_json(turns).alias("value"))
    path = _folder(spark)
    lines.where("conv_id % 2 = 0").select("value").write.text(f"{path}/even")
    lines.where("conv_id % 2 = 1").select("value").write.option("compression", "gzip").text(f"{path}/odd")
    even, odd = (readers.dialogues(spark, f"{path}/{x}") for x in ("even", "odd"))
    rows = even.unionByName(odd)
    return rows.groupBy("dataset", "turn", "text").agg(F.count("*").alias("lines"))


def instances_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON documents of a hundred texts each and read back piece by piece."""
    tune(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: F.struct(x["text"].alias("text")))
    whole = docs.groupBy(F.floor(F.col("doc_id") / 100).alias("part")).agg(texts.alias("instances"))
    path = f"{_folder(spark)}/docs"
    value = F.to_json(F.struct(F.lit("text_only").alias("type"), "instances")).alias("value")
    whole.select(value).write.option("maxRecordsPerFile", 1).text(path)
    return readers.instances(spark, f"{path}/*.txt", split=True).select("session_id", "text")


def cleaned_files(spark: SparkSession, sf: str) -> DataFrame:
    """Segments written as text lines, those too large for a line beside them, and read back."""
    rows, long = _t(spark, sf)
    path = _folder(spark)
    writers.write_text(sessions.segment(rows, long), path, max_turns=6)
    return readers.cleaned(spark, path).groupBy("turn", "text").agg(F.count("*").alias("lines"))


def jsonl_files(spark: SparkSession, sf: str) -> DataFrame:
    """Segments written as JSON arrays and read back as dialogues."""
    rows, long = _t(spark, sf)
    path = _folder(spark)
    writers.write_jsonl(sessions.segment(rows, long), path)
    back = readers.dialogues(spark, f"{path}/lines/*/*.txt")
    return back.groupBy("dataset", "turn", "text").agg(F.count("*").alias("lines"))


def audit_files(spark: SparkSession, sf: str) -> DataFrame:
    """The audit written to files and its entries read back."""
    path = _folder(spark)
    writers.write_audit(_audit(spark, sf), path)
    entries = spark.read.parquet(f"{path}/entries")
    return entries.groupBy("category", "reason").agg(F.count("*").alias("entries"))


def title_cut(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", T.before_title_end(F.col("html")).alias("html"))


def title_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as sessions of two turns, their address and their source, each cut at the end of a title."""
    tune(spark)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    turns = pages.select("page_id", F.posexplode(F.array("url", "html")).alias("turn", "text"))
    return sessions.cut_titles(to_utterances(turns, "page_id", "turn")).select("session_id", "turn", "text")


def emoji_strip(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).select(*KEYS, T.remove_emoji(F.col("text")).alias("text"))


def emoji_first(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).select(*KEYS, T.first_emoji(F.col("text")).alias("emoji")).where("emoji != ''")


def repost_split(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.split_parts(_u(spark, sf))[0].select(*KEYS, "part", "text")


def vote_drop(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.split_parts(_u(spark, sf), drop_votes=True)[0].select(*KEYS, "part", "text")


def repeats_reduced(spark: SparkSession, sf: str) -> DataFrame:
    return apply_named(_u(spark, sf), "B23").select(*KEYS, "text")


def repeats_found(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).select(*KEYS, T.has_repeat(F.col("text"), 4).alias("repeated"))


def char_runs_capped(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).select(*KEYS, T.cap_char_runs(F.col("text"), no_single=True).alias("text"))


def uniform_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.uniform_sessions(B.with_block(_u(spark, sf))).select(*SESSION)


def uniform_drop(spark: SparkSession, sf: str) -> DataFrame:
    rows = _u(spark, sf)
    return sessions.drop_uniform(B.with_block(rows), B.is_long(rows))[0].select(*KEYS, "text")


def lexicon_load(spark: SparkSession, sf: str) -> DataFrame:
    return black(spark, sf).df.select("word", "ord")


def lexicon_first_n(spark: SparkSession, sf: str) -> DataFrame:
    return black(spark, sf, first=25).df.select("word", "ord")


def special_topic(spark: SparkSession, sf: str) -> DataFrame:
    rows = lexicon.first_contained(_u(spark, sf), T.tight(F.col("text")), topics(spark, sf), "topic", UTTERANCE)
    return rows.where("topic IS NOT NULL").select(*KEYS, "topic")


def substring_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = lexicon.first_contained(_u(spark, sf), F.col("text"), black(spark, sf), "word", UTTERANCE)
    return rows.where("word IS NOT NULL").select(*KEYS, "word")


def substring_set(spark: SparkSession, sf: str) -> DataFrame:
    found = lexicon.contained_words(_u(spark, sf), F.col("text"), black(spark, sf), UTTERANCE)
    return found.select(*KEYS, F.array_join("words", "|").alias("words"))


def alternation_last(spark: SparkSession, sf: str) -> DataFrame:
    got = lexicon.last_alternation(_u(spark, sf), F.col("text"), topics(spark, sf), "word", UTTERANCE)
    return got.select(*KEYS, "word").where("word IS NOT NULL")


def substring_hits(spark: SparkSession, sf: str) -> DataFrame:
    hits = lexicon.substring_hits(_u(spark, sf), F.col("text"), black(spark, sf), UTTERANCE)
    return hits.select(*KEYS, F.col("end").cast("int").alias("fin"), "word")


def large_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of a very long word list, counted per utterance, with the longest word found."""
    hits = lexicon.substring_hits(_u(spark, sf), F.col("text"), large(spark, sf), UTTERANCE)
    longest = F.min(F.struct((-F.col("len")).alias("n"), "word"))
    return hits.groupBy(*KEYS).agg(F.count("*").alias("hits"), F.count_distinct("word").alias("words"), longest["word"].alias("longest"))


def substring_remove(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.remove_substrings(_u(spark, sf), black(spark, sf)).select(*KEYS, "text", "black_word")


def word_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    rows = _u(spark, sf)
    facts = lexicon.word_facts(rows, T.tokens(F.col("text")), KEYS, blacklist=bad_tokens(spark, sf))
    return facts.select(*KEYS, F.col("black_token").alias("word"))


def alpha_noise(spark: SparkSession, sf: str) -> DataFrame:
    rows = _u(spark, sf)
    facts = lexicon.word_facts(rows, T.tokens(F.col("text")), KEYS, english=english(spark, sf))
    return facts.select(*KEYS, F.col("noise_word").alias("word"))


def confused_word(spark: SparkSession, sf: str) -> DataFrame:
    rows = lexicon.confused_tokens(_u(spark, sf), T.tokens(F.col("text")), topics(spark, sf), "word", UTTERANCE)
    return rows.where("word IS NOT NULL").select(*KEYS, "word")


def word_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).where(T.too_repetitive(T.tokens(F.col("text")))).select(*KEYS)


def tokenised(spark: SparkSession, sf: str) -> DataFrame:
    return _u(spark, sf).select(*KEYS, F.array_join(T.tokens(F.col("text")), " ").alias("text"))


def unspaced_words(spark: SparkSession, sf: str) -> DataFrame:
    """Dialogue turns with their blanks taken out, cut again by a dictionary of all words of the dialogues."""
    tune(spark)
    path = f"{sf}/conversations.parquet"
    chats = scale.spread(spark.read.parquet(path).select("conv_id", "turn", "text"), path, ["conv_id", "turn"])
    words = chats.select(F.explode(T.tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("count"))
    words = segmentation.Dictionary.of(words)
    rows = segmentation.segmented(chats, T.tight(F.col("text")), words, "words", ["conv_id", "turn"], whole=True)
    return rows.select("conv_id", "turn", F.array_join("words", "|").alias("words"))


def segment_sessions(spark: SparkSession, sf: str) -> DataFrame:
    rows, long = _t(spark, sf)
    return sessions.segment(rows, long).select(*SEGMENT, "turn", "text")


def segment_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows, long = _t(spark, sf)
    return writers.segment_lines(sessions.segment(rows, long)).select(*SEGMENT, "line")


def multi_turn_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows, long = _t(spark, sf)
    return sessions.segment(rows, long, min_turns=2).select(*SEGMENT, "turn", "text")


def short_response_trim(spark: SparkSession, sf: str) -> DataFrame:
    rows, long = _t(spark, sf)
    return sessions.segment(rows, long, no_short_response=True).select(*SEGMENT, "turn", "text")


def rename_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = _u(spark, sf)
    out = sessions.rename_names(B.with_block(rows), names(spark, sf), B.is_long(rows))
    return out.select(*KEYS, "text")


def _segments(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    rows, long = _t(spark, sf)
    return sessions.segment(rows, long), long


def ad_responses(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.ad_responses(*_segments(spark, sf)).select("text", "contexts")


def ad_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.ranked_ads(corpus.ad_responses(*_segments(spark, sf))).select("text", "contexts")


def ad_cut(spark: SparkSession, sf: str) -> DataFrame:
    segments, long = _segments(spark, sf)
    ads = checkpoint(corpus.ad_responses(segments, long))
    return corpus.cut_ads(segments, ads, long).select(*SEGMENT, "turn", "text")


def trigram_counts(spark: SparkSession, sf: str) -> DataFrame:
    segments, long = _segments(spark, sf)
    return corpus.trigram_counts(segments, long=long).select("trigram", "responses")


def generic_trigrams(spark: SparkSession, sf: str) -> DataFrame:
    segments, long = _segments(spark, sf)
    return corpus.generic_trigrams(corpus.trigram_counts(segments, long=long), GENERIC_MIN).select("trigram", "responses")


def generic_cut(spark: SparkSession, sf: str) -> DataFrame:
    segments, long = _segments(spark, sf)
    segments = scale.stored(segments)  # both passes read them
    generic = checkpoint(corpus.generic_trigrams(corpus.trigram_counts(segments, long=long), GENERIC_MIN))
    return corpus.cut_generic(segments, generic, long).select(*SEGMENT, "turn", "text")


AUDIT_RULES = CleanConfig().on(
    "no_specific_utter", "de_hashtag", "de_html", "no_mention", "de_emoji", "de_phone", "de_qq", "cleantext_clean", "no_short"
)


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return clean(_u(spark, sf), AUDIT_RULES).audit


def audit_entries(spark: SparkSession, sf: str) -> DataFrame:
    return _audit(spark, sf).select(*KEYS, "category", "reason", "before", "after")


def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.rule_counts(_audit(spark, sf)).select("category", "reason", "utterances")


def audit_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return A.deltas(_audit(spark, sf)).select(*KEYS, "category", "reason", "len_before", "len_after", "removed")


def _word_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = lexicon.remove_substrings(_u(spark, sf).withColumn("before", F.col("text")), black(spark, sf))
    hits = rows.where("black_word IS NOT NULL")
    return hits.select(*UTTERANCE, F.lit("str_blacklist").alias("category"), F.col("black_word").alias("reason"), "before")


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.word_counts(_word_audit(spark, sf)).select("word", "utterances")


def word_utterances(spark: SparkSession, sf: str) -> DataFrame:
    return A.word_utterances(_word_audit(spark, sf)).select("dataset", "file_id", "word", "utterance")


def corpus_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corpus_statistics(_u(spark, sf), ["dataset"])


def raw_statistics(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    chats = spark.read.parquet(f"{sf}/conversations.parquet")
    return stats.corpus_statistics(to_utterances(chats, "conv_id", "turn", dataset=F.lit("chats")))


def mention_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return stats.mentioning_sessions(_u(spark, sf)).select(*SESSION)


def symbol_census(spark: SparkSession, sf: str) -> DataFrame:
    return stats.symbol_census(_u(spark, sf), symbols(spark, sf)).select("symbol", "sessions")


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return stats.reconcile(docs, labels, ["doc_id"]).select("status", "doc_id")


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return classify.class_counts(classify.join_labels(docs, labels, "doc_id", "toxic"))


def inoffensive_texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = classify.fit_offence_model(classify.join_labels(docs, labels, "doc_id", "toxic"))
    return classify.inoffensive(docs, model).select("doc_id")


def offensive_by_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return classify.counted_scores(docs, classify.join_labels(docs, labels, "doc_id", "toxic"), "doc_id")


BASIC = CleanConfig.basic().off("no_str_blacklist")


def clean_basic(spark: SparkSession, sf: str) -> DataFrame:
    return clean(_u(spark, sf), BASIC).segments.select(*SEGMENT, "turn", "text")


def clean_basic_words(spark: SparkSession, sf: str) -> DataFrame:
    """The basic profile whole, with its lexicon."""
    lex = Lexicons(str_blacklist=black(spark, sf))
    return clean(_u(spark, sf), CleanConfig.basic(), lex).segments.select(*SEGMENT, "turn", "text")


def clean_basic_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corpus_statistics(clean(_u(spark, sf), BASIC).segments, ["dataset"], SEGMENT)


def clean_full(spark: SparkSession, sf: str) -> DataFrame:
    """The full profile without the repeat rule, which the oracle cannot state."""
    cfg = CleanConfig.full().off("de_duplicated")
    return clean(_u(spark, sf), cfg).segments.select(*SEGMENT, "turn", "part", "text")


def clean_everything(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule and pass at once, with lexicons: the segments and, with ``category`` set, the audit.

    The confusable rule only tags, so its whole result is in the audit.
    """
    rows = _u(spark, sf)
    lex = Lexicons(
        black(spark, sf), bad_tokens(spark, sf), topics(spark, sf), names(spark, sf), english(spark, sf), confusables(spark, sf)
    )
    cfg = CleanConfig.full().on(
        "no_utter_dup", "no_str_blacklist", "no_special_topic", "no_alpha_noise", "no_word_blacklist", "check_confuse_word",
        "yda_dedupl", "re_name", "no_short_response", "no_ad", "de_generic_dialog", "de_angle", "de_emotion",
        "de_html", "de_mention", "de_repost", "no_short",
    ).off("contain_zh", "no_mention")
    out = clean(rows, cfg, lex)
    return out.segments.select(*SEGMENT, "turn", "part", "text").unionByName(out.audit, allowMissingColumns=True)


_NAMED: list[Query] = [
    dialogue_files, instances_files, cleaned_files, jsonl_files, audit_files,
    title_cut, title_turns, emoji_strip, emoji_first, repost_split, vote_drop, repeats_reduced, repeats_found, char_runs_capped,
    uniform_sessions, uniform_drop, lexicon_load, lexicon_first_n, special_topic, substring_first, substring_set,
    alternation_last, substring_hits, large_lexicon, substring_remove, word_blacklist, alpha_noise, confused_word, word_repetition,
    tokenised, unspaced_words, segment_sessions, segment_lines, multi_turn_segments, short_response_trim, rename_names, ad_responses,
    ad_ranking, ad_cut, trigram_counts, generic_trigrams, generic_cut, audit_entries, audit_counts, audit_deltas,
    word_counts, word_utterances, corpus_statistics, raw_statistics, mention_sessions, symbol_census, reconcile,
    label_counts, inoffensive_texts, offensive_by_counts, clean_basic, clean_basic_words, clean_basic_statistics, clean_full, clean_everything,
]


def queries() -> dict[str, Query]:
    rules = {f"rule_{rid.lower()}": _rule(rid) for rid in RULES if rid != "B23"}
    return {**rules, **{q.__name__: q for q in _NAMED}}
