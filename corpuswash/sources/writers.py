"""Writers for cleaned segments and for the audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.model import POSITION, SEGMENT
from corpuswash.operators import audit as A

TURN_SEPARATOR = "\t\t"
MAX_LINE_TURNS = 1024
MAX_LINE_CHARS = 16 << 20


def _line_text(text: Column) -> Column:
    return F.regexp_replace(text, r"[\n\r]", " ")


def segment_lines(segments: DataFrame) -> DataFrame:
    """One line per segment.  For segments known to be of line size; see ``write_text``."""
    ordered = F.array_sort(F.collect_list(F.struct(*POSITION, _line_text(F.col("text")).alias("text"))))
    lines = segments.groupBy(*SEGMENT).agg(F.transform(ordered, lambda x: x["text"]).alias("turns"))
    return lines.select(*SEGMENT, "turns", F.concat_ws(TURN_SEPARATOR, "turns").alias("line"))


def by_size(segments: DataFrame, max_turns: int = MAX_LINE_TURNS, max_chars: int = MAX_LINE_CHARS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of segments that fit a line, and rows of the others (``None`` if there are none).

    Sizes come from one partial aggregation.  The list of oversized segments is short by
    construction (each holds more than ``max_turns`` turns or ``max_chars`` characters).
    """
    sizes = segments.groupBy(*SEGMENT).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c"))
    big = sizes.where((F.col("n") > max_turns) | (F.col("c") > max_chars)).select(*SEGMENT)
    if big.isEmpty():
        return segments, None
    return segments.join(big, SEGMENT, "left_anti"), segments.join(big, SEGMENT, "left_semi")


def _write_big(rows: DataFrame | None, path: str) -> None:
    """Oversized segments go, whole, to ``path`` as one turn per JSON line in order."""
    if rows is not None:
        rows.repartitionByRange(*SEGMENT, *POSITION).sortWithinPartitions(*SEGMENT, *POSITION).write.mode(
            "overwrite"
        ).partitionBy("dataset").json(path)


def write_text(segments: DataFrame, path: str, max_turns: int = MAX_LINE_TURNS, max_chars: int = MAX_LINE_CHARS) -> None:
    """``path/lines/dataset=.../``: one segment per line, turns separated by two tabs.
    Segments too large for a line go to ``path/oversized``."""
    fit, big = by_size(segments, max_turns, max_chars)
    segment_lines(fit).select("dataset", F.col("line").alias("value")).write.mode("overwrite").partitionBy(
        "dataset"
    ).text(f"{path}/lines")
    _write_big(big, f"{path}/oversized")


def write_jsonl(segments: DataFrame, path: str, max_turns: int = MAX_LINE_TURNS, max_chars: int = MAX_LINE_CHARS) -> None:
    """As ``write_text`` with one JSON array of turns per line."""
    fit, big = by_size(segments, max_turns, max_chars)
    lines = segment_lines(fit).select("dataset", F.to_json("turns").alias("value"))
    lines.write.mode("overwrite").partitionBy("dataset").text(f"{path}/lines")
    _write_big(big, f"{path}/oversized")


def write_audit(audit: DataFrame, path: str) -> None:
    """Distinct audit entries, the lexicon word counts and the word → utterance lists.

    The lists are made from the written entries, of which they read the lexicon categories only, so that the job behind the
    audit runs once.
    """
    entries = A.distinct_hits(audit)
    entries.write.mode("overwrite").partitionBy("category").parquet(f"{path}/entries")
    audit = audit.sparkSession.read.schema(entries.schema).parquet(f"{path}/entries")
    A.word_counts(audit).write.mode("overwrite").json(f"{path}/word_counts")
    A.word_utterances(audit).repartition("word", "utterance").sortWithinPartitions("category", "word").write.mode(
        "overwrite"
    ).partitionBy("category").json(f"{path}/word_utterances")


def write_word_counts_by_file(audit: DataFrame, path: str) -> None:
    """Word counts per source file, most frequent first."""
    hits = A.distinct_hits(audit).where(F.col("category").isin(*A.LEXICON_CATEGORIES))
    counts = hits.groupBy("dataset", "file_id", "category", F.col("reason").alias("word")).agg(
        F.count("*").alias("utterances")
    )
    counts.orderBy("dataset", "file_id", "category", F.desc("utterances"), "word").write.mode("overwrite").json(path)
