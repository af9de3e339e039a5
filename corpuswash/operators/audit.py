"""Views of the audit table ``(utterance key, category, reason, before, after)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEXICON_CATEGORIES = ("str_blacklist", "word_blacklist")


def distinct_hits(audit: DataFrame) -> DataFrame:
    """Distinct entries per source file, category and reason."""
    return audit.select("dataset", "file_id", "category", "reason", "before", "after").distinct()


def rule_counts(audit: DataFrame) -> DataFrame:
    """Distinct utterances per category and reason.  Distinct rows are formed first, so one rule
    that hits everywhere is spread over many tasks."""
    return (
        audit.select("category", "reason", "before", "after")
        .distinct()
        .groupBy("category", "reason")
        .agg(F.count("*").alias("utterances"))
    )


def word_counts(audit: DataFrame, categories: tuple[str, ...] = LEXICON_CATEGORIES) -> DataFrame:
    """Lexicon words by number of distinct utterances, most frequent first."""
    hits = audit.where(F.col("category").isin(*categories)).select("category", F.col("reason").alias("word"), "before")
    counts = hits.distinct().groupBy("category", "word").agg(F.count("*").alias("utterances"))
    return counts.orderBy("category", F.desc("utterances"), "word")


def word_utterances(audit: DataFrame, categories: tuple[str, ...] = LEXICON_CATEGORIES) -> DataFrame:
    """Inverted list: one row per (word, distinct utterance), grouped by word in the writer."""
    hits = audit.where(F.col("category").isin(*categories))
    return hits.select("dataset", "file_id", "category", F.col("reason").alias("word"), F.col("before").alias("utterance")).distinct()


def deltas(audit: DataFrame) -> DataFrame:
    """Characters removed by the rules that log before and after."""
    pairs = audit.where(F.col("after").isNotNull())
    return pairs.select(
        "dataset", "file_id", "session_id", "turn", "part", "category", "reason",
        F.length("before").alias("len_before"),
        F.length("after").alias("len_after"),
        (F.length("before") - F.length("after")).alias("removed"),
    )
