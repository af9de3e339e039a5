"""Corpus-level passes: advertisement responses and generic responses."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import repeats
from corpuswash.functions import text as T
from corpuswash.model import SEGMENT, UTTERANCE
from corpuswash.operators import blocks as B
from corpuswash.plans import workers
from corpuswash.plans.scale import lookup_join

SCOPES = {"corpus": [], "file": ["dataset", "file_id"]}


def responses(rows: DataFrame, long: bool, key: list[str] = SEGMENT) -> DataFrame:
    """Turns that answer another turn, with that turn in ``context``."""
    return B.previous_text(rows, "context", long, key).where(F.col("context").isNotNull())


def ad_responses(
    rows: DataFrame,
    long: bool,
    key: list[str] = SEGMENT,
    scope: str = "corpus",
    min_len: int = P.AD_MIN_LEN,
    min_contexts: int = P.AD_MIN_CONTEXTS,
) -> DataFrame:
    """Long responses that follow more than ``min_contexts`` different turns.

    Length is tested before anything is shuffled; the distinct pairs are combined on the map
    side and spread by (response, context), so one popular response is not one task.
    """
    by = SCOPES[scope]
    pairs = responses(rows, long, key).where(T.tight_len(F.col("text")) > min_len)
    pairs = pairs.select(*by, "text", "context").distinct()
    return pairs.groupBy(*by, "text").agg(F.count("*").alias("contexts")).where(F.col("contexts") > min_contexts)


def ranked_ads(ads: DataFrame) -> DataFrame:
    """Advertisement list, most contexts first."""
    return ads.orderBy(F.desc("contexts"), "text")


def flag_texts(rows: DataFrame, texts: DataFrame, out: str, scope: str = "corpus") -> DataFrame:
    on = [*SCOPES[scope], "text"]
    marked = texts.select(*on).withColumn(out, F.lit(True))
    joined = lookup_join(rows, marked, on, "left", UTTERANCE)
    return joined.withColumn(out, F.coalesce(out, F.lit(False))).select(*rows.columns, out)


def cut_ads(rows: DataFrame, ads: DataFrame, long: bool, key: list[str] = SEGMENT, scope: str = "corpus") -> DataFrame:
    """Cut segments at advertisement responses more than two turns after the piece start."""
    flagged = flag_texts(rows, ads, "_ad", scope)
    return _cut(flagged, F.col("_ad"), 2, long, key).drop("_ad")


def _cut(rows: DataFrame, hit: Column, gap: int, long: bool, key: list[str]) -> DataFrame:
    cols = list(rows.columns)
    out = B.cut_pieces(rows, hit, gap, long, key)
    if "segment" in key:
        out = out.withColumn("segment", F.concat_ws(".", "segment", F.col("piece").cast("string"))).drop("piece")
    else:
        cols = [*cols, "piece"]
    return out.select(*cols)


def trigram_counts(rows: DataFrame, scope: str = "corpus", key: list[str] = SEGMENT, long: bool = False) -> DataFrame:
    """In how many responses does each character trigram occur?  (Spaces do not count.)"""
    by = SCOPES[scope]
    grams = F.explode(F.array_distinct(T.grams(T.tight(F.col("text")), 3)))
    return (
        replies(rows, long, key)
        .select(*by, grams.alias("trigram"))
        .groupBy(*by, "trigram")
        .agg(F.count("*").alias("responses"))
    )


def replies(rows: DataFrame, long: bool, key: list[str]) -> DataFrame:
    """All turns but the first of each ``key``: the text of the turn before is not needed."""
    return B.running_sum(rows, F.lit(1).cast("long"), "_before", long, key).where("_before > 0").drop("_before")


def generic_trigrams(counts: DataFrame, min_count: int = P.GENERIC_MIN_COUNT) -> DataFrame:
    return counts.where(F.col("responses") > min_count)


def covering(text: str) -> list[str]:
    """Trigrams that make up more than nine tenths of a text.

    Such a trigram fills more than 30 % of the sorted trigram list, so it stands at one of the
    list positions 0, s, 2s, ... with s = 30 % of the length; only these few are counted.
    """
    n = len(text)
    if n < 3:
        return []
    c = repeats.points_of(text).astype(np.int64)
    grams = np.sort(c[:-2] << 42 | c[1:-1] << 21 | c[2:])  # three code points of 21 bits
    some = np.unique(grams[:: max(n * 3 // 10, 1)])
    count = np.searchsorted(grams, some, "right") - np.searchsorted(grams, some, "left")
    return ["".join(chr(g >> k & 0x1FFFFF) for k in (42, 21, 0)) for g in some[count * 30 > n * 9].tolist()]


def covering_trigrams(text: Column) -> Column:
    """``covering`` of the text without its spaces, as an array."""
    workers.prepare(SparkSession.active())

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(covering, na_action="ignore")

    return found(T.tight(text))


def generic_responses(rows: DataFrame, generic: DataFrame, scope: str = "corpus") -> DataFrame:
    """Utterances covered by one generic trigram.  Few rows have a covering trigram at all, and
    only those reach the join."""
    by = SCOPES[scope]
    covered = rows.select(*UTTERANCE, covering_trigrams(F.col("text")).alias("_c"))
    dominated = covered.select(*UTTERANCE, F.explode("_c").alias("trigram"))
    table = generic.select(*by, "trigram")
    return lookup_join(dominated, table, [*by, "trigram"], "left_semi", UTTERANCE).select(*UTTERANCE).distinct()


def _flag_generic(rows: DataFrame, generic: DataFrame, scope: str) -> DataFrame:
    hits = generic_responses(rows, generic, scope).withColumn("_gen", F.lit(True))
    return rows.join(hits, UTTERANCE, "left").select(*rows.columns, F.coalesce("_gen", F.lit(False)).alias("_gen"))


def cut_generic(rows: DataFrame, generic: DataFrame, long: bool, key: list[str] = SEGMENT, scope: str = "corpus") -> DataFrame:
    """Cut segments at generic responses more than one turn after the piece start."""
    return _cut(_flag_generic(rows, generic, scope), F.col("_gen"), 1, long, key).drop("_gen")


def generic_hits(rows: DataFrame, generic: DataFrame, long: bool, key: list[str] = SEGMENT, scope: str = "corpus") -> DataFrame:
    """Generic responses met by the cut scan: every one that does not start a piece."""
    marked = B.mark_pieces(_flag_generic(rows, generic, scope), F.col("_gen"), 1, long, key)
    return marked.where(F.col("_gen") & ~F.col("_fresh")).select(*UTTERANCE, T.tight(F.col("text")).alias("text"))
