"""Fold rules into projections over the utterance table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import text as T
from corpuswash.operators.rules import RULES, Context, Rule

HIT = "struct<category:string,reason:string,before:string,after:string>"


def prepare(rows: DataFrame, audit: bool) -> DataFrame:
    """Add what the chain carries: the original text and, with audit, the hits so far."""
    rows = rows.withColumn("orig", F.col("text"))
    if audit:
        rows = rows.withColumn("hits", F.array().cast(f"array<{HIT}>"))
    return rows


def hit(category: Column, reason: Column, before: Column | None = None, after: Column | None = None) -> Column:
    """One audit entry; ``before`` stays null when it is the original utterance."""
    none = F.lit(None).cast("string")
    return F.struct(
        category.alias("category"),
        reason.alias("reason"),
        (none if before is None else before).alias("before"),
        (none if after is None else after).alias("after"),
    )


def _hit_of(rule: Rule, before: Column, after: Column, orig: Column) -> Column:
    category, reason = F.lit(rule.category), F.lit(rule.reason)
    if rule.audit == "pair":
        return hit(category, reason, before, after)
    if rule.audit == "emoji":
        return hit(category, reason, F.concat(F.regexp_extract(before, P.EMOJI, 0), F.lit(": "), orig))
    return hit(category, reason)


def apply_rule(rows: DataFrame, rule: Rule) -> DataFrame:
    """One projection per rule.  An empty text stays empty under every rule."""
    text = F.col("text")
    ctx = Context(F.col("orig"), T.tight(F.col("orig")), F.col("file_id"))
    if rule.kind == "edit":
        new = rule.fn(text, ctx)
    else:
        new = F.when(rule.fn(text, ctx), F.lit("")).otherwise(text)
    if "hits" not in rows.columns or rule.audit == "none":
        return rows.withColumn("text", new)
    keep = [c for c in rows.columns if c not in ("text", "hits")]
    rows = rows.select(*keep, "hits", "text", new.alias("_new"))
    changed = F.length("_new") < F.length("text")
    entry = _hit_of(rule, F.col("text"), F.col("_new"), F.col("orig"))
    hits = F.when(changed, F.concat("hits", F.array(entry).cast(f"array<{HIT}>"))).otherwise(F.col("hits"))
    return rows.select(*keep, hits.alias("hits"), F.col("_new").alias("text"))


def apply_rules(rows: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    for rule in rules:
        rows = apply_rule(rows, rule)
    return rows


def apply_named(rows: DataFrame, *ids: str) -> DataFrame:
    """Apply single rules by id to an utterance table."""
    return apply_rules(prepare(rows, audit=False), [RULES[i] for i in ids]).drop("orig")


def explode_hits(rows: DataFrame) -> DataFrame:
    """Audit rows from the carried hits."""
    entries = rows.where(F.size("hits") > 0).select(
        "dataset", "file_id", "session_id", "turn", "part", "orig", F.explode("hits").alias("h")
    )
    return entries.select(
        "dataset",
        "file_id",
        "session_id",
        "turn",
        "part",
        "h.category",
        "h.reason",
        F.coalesce("h.before", "orig").alias("before"),
        "h.after",
    )
