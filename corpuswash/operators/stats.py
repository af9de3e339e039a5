"""Corpus statistics, symbol census and output reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import text as T
from corpuswash.model import POSITION, SESSION
from corpuswash.operators.lexicon import Lexicon

SYMBOL_CLASS_LIMIT = 5000


def mentioning_sessions(rows: DataFrame, key: list[str] = SESSION) -> DataFrame:
    """Sessions whose turns, joined by spaces, contain a mention.

    A joined text has a closed mention if a turn has one, where a turn that another turn follows
    counts with the joining space; or if the joined text's last 29 characters contain an ``@``.
    Those characters lie in the last 30 turns, which a limited window finds with a map-side
    top-30, so the length of a session does not matter.
    """
    text = F.col("text")
    seen = rows.select(*key, *POSITION, "text")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in POSITION]))
    tail = seen.select(*key, *POSITION, F.right(text, F.lit(P.MENTION_TAIL - 1)).alias("end"), text)
    tail = tail.withColumn("rn", rank).where(F.col("rn") <= P.MENTION_TAIL)
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(*POSITION, "end"))), lambda x: x["end"]), " "
    )
    ends = tail.groupBy(*key).agg(
        F.contains(F.right(joined, F.lit(P.MENTION_TAIL - 1)), F.lit("@")).alias("near_end"),
        F.bool_or((F.col("rn") == 1) & _closed(F.concat("text", F.lit(" "))) & ~_closed(text)).alias("last_open"),
    )
    flags = seen.where(F.contains(text, F.lit("@"))).groupBy(*key).agg(
        F.sum(_closed(F.concat("text", F.lit(" "))).cast("long")).alias("closed")
    )
    both = ends.join(flags, key)
    hit = F.col("near_end") | (F.col("closed") > F.col("last_open").cast("long"))
    return both.where(hit).select(*key)


def _closed(text: Column) -> Column:
    return F.rlike(text, F.lit(P.MENTION))


def corpus_statistics(rows: DataFrame, by: list[str] | None = None, key: list[str] = SESSION) -> DataFrame:
    """Sessions, multi-turn sessions, utterances, characters, sessions with a mention, and the
    derived averages, per ``by`` columns (a subset of ``key``)."""
    by = by or []
    sessions = rows.groupBy(*key).agg(F.count("*").alias("turns"), F.sum(T.tight_len(F.col("text"))).alias("chars"))
    sessions = sessions.join(mentioning_sessions(rows, key).withColumn("at", F.lit(1)), key, "left")
    totals = sessions.groupBy(*by).agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("turns") > 2).alias("multi"),
        F.coalesce(F.sum("turns"), F.lit(0)).alias("utterances"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
        F.count("at").alias("have_at"),
    )
    single = F.col("sessions") - F.col("multi")
    return totals.select(
        *by, "sessions", "multi", "utterances", "chars", "have_at",
        F.try_divide("chars", "utterances").alias("avg_word"),
        single.alias("single"),
        F.try_divide(F.col("utterances") - 2 * single, F.col("multi")).alias("avg_multi_utter"),
    )


def symbol_census(rows: DataFrame, symbols: Lexicon, key: list[str] = SESSION) -> DataFrame:
    """Sessions by their first known symbol; sessions with CJK radicals count as ``no_emoji``."""
    singles = symbols.df.where(F.length("word") == 1)
    base = rows.select(*key, *POSITION, "text")
    if symbols.rows <= SYMBOL_CLASS_LIMIT:
        known = [r["word"] for r in singles.orderBy("word").collect()]
        cls = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in known) + "]" if known else "(?!)"
        found = base.withColumn("symbol", F.nullif(F.regexp_extract("text", cls, 0), F.lit("")))
    else:
        letters = base.select(*key, *POSITION, F.posexplode(T.chars(F.col("text"))).alias("pos", "word"))
        hits = symbols.join(letters, "word", "left_semi", [*key, *POSITION, "pos"])
        first = hits.groupBy(*key, *POSITION).agg(F.min_by("word", "pos").alias("symbol"))
        found = base.join(first, [*key, *POSITION], "left")
    per_session = found.groupBy(*key).agg(
        F.bool_or(F.rlike("text", F.lit(P.RADICALS))).alias("radical"),
        F.min_by("symbol", F.when(F.col("symbol").isNotNull(), F.struct(*POSITION))).alias("symbol"),
    )
    named = per_session.select(F.when(F.col("radical"), F.lit("no_emoji")).otherwise(F.col("symbol")).alias("symbol"))
    return named.where("symbol IS NOT NULL").groupBy("symbol").agg(F.count("*").alias("sessions"))


def reconcile(expected: DataFrame, produced: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has: ``status`` is ``not_in_result`` or ``not_in_raw``."""
    left, right = expected.select(*key).distinct(), produced.select(*key).distinct()
    missing = left.join(right, key, "left_anti").withColumn("status", F.lit("not_in_result"))
    surplus = right.join(left, key, "left_anti").withColumn("status", F.lit("not_in_raw"))
    return missing.unionByName(surplus)
