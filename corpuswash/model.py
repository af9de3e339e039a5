"""The tables the engine works on.

``utterances(dataset, file_id, session_id, turn, part, text)`` has one row per utterance.
``(dataset, file_id, session_id)`` names a session, ``turn`` is the position in it and
``part`` the position inside a split repost.  An empty ``text`` means "removed".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SESSION = ["dataset", "file_id", "session_id"]
POSITION = ["turn", "part"]
UTTERANCE = SESSION + POSITION
SEGMENT = SESSION + ["segment"]


def to_utterances(
    df: DataFrame,
    session: str | Column,
    turn: str | Column | None = None,
    text: str | Column = "text",
    dataset: str | Column | None = None,
    file_id: str | Column | None = None,
) -> DataFrame:
    """Map any table to the utterance schema; without ``turn`` each row is its own session."""

    def col(x: str | Column | None, default: Column) -> Column:
        if x is None:
            return default
        return F.col(x) if isinstance(x, str) else x

    ds = col(dataset, F.lit("table"))
    return df.select(
        ds.cast("string").alias("dataset"),
        col(file_id, ds).cast("string").alias("file_id"),
        col(session, F.lit(0)).cast("long").alias("session_id"),
        col(turn, F.lit(0)).cast("long").alias("turn"),
        F.lit(0).alias("part"),
        F.coalesce(col(text, F.lit("")), F.lit("")).alias("text"),
    )


def known_keys(rows: DataFrame) -> DataFrame:
    """The utterance columns without nulls.

    A null key would fall out of every join; and keys that cannot be null need no null filter,
    which would make the two inputs of a self-join differ and be computed twice.
    """
    text = {c: F.coalesce(c, F.lit("")).alias(c) for c in ("dataset", "file_id", "text")}
    session = F.coalesce(F.col("session_id").cast("long"), F.lit(-1).cast("long")).alias("session_id")
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn")
    part = F.coalesce(F.col("part").cast("int"), F.lit(0)).alias("part")
    return rows.select(text["dataset"], text["file_id"], session, turn, part, text["text"])


def session_lists(rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per session (or segment) with its turns in order.

    Only for keys whose size is known to be small; the engine itself keeps one row per turn.
    """
    key = key or SESSION
    turns = F.array_sort(F.collect_list(F.struct(*POSITION, "text")))
    return rows.groupBy(*key).agg(F.transform(turns, lambda x: x["text"]).alias("turns"))
