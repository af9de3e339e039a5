"""Session-level operators on the one-row-per-turn table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import text as T
from corpuswash.model import POSITION, SEGMENT, SESSION, UTTERANCE
from corpuswash.operators import blocks as B
from corpuswash.operators.lexicon import Lexicon
from corpuswash.plans import workers


def split_parts(rows: DataFrame, drop_votes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split repost chains into consecutive parts.

    With ``drop_votes``, a part followed by a vote advertisement goes together with it.
    Returns the rows and the audit rows of the removed pairs.
    """
    parts = rows.withColumn("_p", T.split_reposts(F.col("text")))
    keep = [c for c in rows.columns if c not in ("part", "text")]
    if not drop_votes:
        out = parts.select(*keep, F.posexplode("_p").alias("part", "text"))
        return out.select(*rows.columns), audit_rows(rows.where(F.lit(False)), "other", "toupiao")
    marked = parts.withColumn("_m", T.mark_votes(F.col("_p")))
    out = marked.select(*keep, F.explode(F.filter("_m", lambda m: ~m["gone"])).alias("_e"))
    out = out.select(*keep, F.col("_e.part").alias("part"), F.col("_e.text").alias("text"))
    pairs = F.transform(
        F.filter("_m", lambda m: m["vote"]),
        lambda m: F.struct(
            m["part"].alias("part"),
            F.concat(m["text"], F.lit("\t\t"), F.get(F.col("_p"), m["part"] + 1)).alias("text"),
        ),
    )
    gone = marked.where(F.exists("_m", lambda m: m["vote"])).select(*keep, F.explode(pairs).alias("_e"))
    gone = gone.select(*keep, F.col("_e.part").alias("part"), F.col("_e.text").alias("text"))
    return out.select(*rows.columns), audit_rows(gone, "other", "toupiao")


def audit_rows(rows: DataFrame, category: str, reason: str) -> DataFrame:
    return rows.select(
        *UTTERANCE,
        F.lit(category).alias("category"),
        F.lit(reason).alias("reason"),
        F.col("text").alias("before"),
        F.lit(None).cast("string").alias("after"),
    )


def uniform_sessions(rows: DataFrame) -> DataFrame:
    """Sessions whose turns are all the same text (``rows`` carry ``block``).

    Hashes decide for nearly all sessions: two different hashes are two different texts.
    Sessions of one turn are uniform; only longer ones whose hashes all agree compare texts.
    """
    h = F.xxhash64("text")
    facts = B.facts_by(rows, SESSION, F.min(h).alias("_lo"), F.max(h).alias("_hi"), F.count("*").alias("_n"))
    alike = facts.where(F.col("_lo") == F.col("_hi"))
    single = alike.where("_n = 1").drop("_lo", "_hi", "_n")
    suspects = alike.where("_n > 1").drop("_lo", "_hi", "_n")
    texts = rows.join(suspects.select(*SESSION), SESSION, "left_semi")
    proven = B.facts_by(texts, SESSION, F.min("text").alias("_a"), F.max("text").alias("_b"))
    return single.unionByName(proven.where(F.col("_a") == F.col("_b")).drop("_a", "_b"))


def drop_uniform(rows: DataFrame, long: bool) -> tuple[DataFrame, DataFrame]:
    """Remove sessions with fewer than two distinct turns; the audit names their first turn."""
    if not long:
        # sessions are small here: one window decides, and its partitioning serves later steps
        w = Window.partitionBy(*SESSION, "block")
        flagged = rows.withColumn("_same", F.min("text").over(w) == F.max("text").over(w))
        flagged = flagged.withColumn("_rn", F.row_number().over(w.orderBy(*POSITION)))
        gone = flagged.where(F.col("_same") & (F.col("_rn") == 1)).drop("_same", "_rn")
        return flagged.where(~F.col("_same")).drop("_same", "_rn"), audit_rows(gone, "other", "less_pair")
    uniform = uniform_sessions(rows)
    kept = B.join_facts(rows, uniform, SESSION, "left_anti", long)
    gone = B.join_facts(rows, uniform, SESSION, "left_semi", long)
    first = gone.groupBy(*SESSION).agg(F.min(F.struct(*POSITION, "text")).alias("_f"))
    first = first.select(*SESSION, "_f.*")
    return kept, audit_rows(first, "other", "less_pair")


def segment(rows: DataFrame, long: bool, no_short_response: bool = False, min_turns: int = 1) -> DataFrame:
    """Break sessions at empty turns; every maximal run of non-empty turns is a segment.

    ``segment`` is the number of empty turns before the row.  With ``no_short_response`` turns
    shorter than two characters are stripped from the end of each segment.
    """
    text = F.col("text")
    rows = B.running_sum(rows, (text == "").cast("long"), "segment", long)
    if no_short_response:
        kind = F.when(text == "", F.lit("blank")).when(T.tight_len(text) >= P.SHORT_LEN, F.lit("full"))
        rows = B.next_known(rows, kind, "_next", long)
        rows = rows.where((F.col("_next") == "full") & (text != "")).drop("_next")
    else:
        rows = rows.where(text != "")
    rows = rows.withColumn("segment", F.col("segment").cast("string"))
    if min_turns > 1:
        if long:
            facts = B.facts_by(rows, SEGMENT, F.count("*").alias("_n"))
            rows = B.join_facts(rows, facts.where(F.col("_n") >= min_turns), SEGMENT, "left_semi", long)
        else:
            w = Window.partitionBy(*SESSION, "block", "segment")
            rows = rows.withColumn("_n", F.count("*").over(w)).where(F.col("_n") >= min_turns).drop("_n")
    return rows


def _renaming(block: list[str], place: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (columns..., words, names) by ``block``: a row with names (word, k) holds for the rows of its block behind it,
    which leave with their text.  A row without its whole key has no names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, tags = None, {}
        for b in batches:
            at, texts = [], []
            keys = zip(*(b.column(c).to_pylist() for c in block), strict=True)
            whole = zip(*(b.column(c).is_valid().to_pylist() for c in (*block, *place)), strict=True)
            for i, (key, known, words, names) in enumerate(zip(keys, whole, b.column("_words").to_pylist(), b.column("_names").to_pylist(), strict=True)):
                if names is not None:
                    owner, tags = key, {x["word"]: f"<NAME{x['k']}>" for x in names}
                    continue
                own = tags if key == owner and all(known) else {}
                at.append(i)
                texts.append(None if words is None else " ".join([own.get(w, w) for w in words]))
            kept = b.drop_columns(["_words", "_names"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(texts, pa.string())], [*kept.schema.names, "text"])

    return run


def rename_names(rows: DataFrame, names: Lexicon, long: bool) -> DataFrame:
    """Replace name tokens by ``<NAMEk>``, k in order of first appearance in the session.

    Turns are re-joined by single spaces.  Of the tokens that are names only the first places are shuffled; the names of a
    block then go ahead of its turns, so that each turn looks its words up in one table.
    """
    workers.prepare(rows.sparkSession)
    block = [*SESSION, "block"]
    words = rows.select(*UTTERANCE, "block", F.posexplode(T.tokens(F.col("text"))).alias("pos", "word"))
    found = names.join(words, "word", "left_semi", UTTERANCE + ["pos"])
    where = F.struct(*POSITION, "pos")
    firsts = found.groupBy(*block, "word").agg(F.min(where).alias("_first"))
    if long:
        key = SESSION + ["word"]
        whole = B.facts_by(firsts, key, F.min("_first").alias("_least"))
        order = Window.partitionBy(*SESSION).orderBy("_least")
        whole = whole.withColumn("k", F.row_number().over(order)).drop("_least")
        ranked = B.join_facts(firsts, whole, key, "inner", long)
    else:
        ranked = firsts.withColumn("k", F.dense_rank().over(Window.partitionBy(*block).orderBy("_first")))
    lists = ranked.groupBy(*block).agg(F.collect_list(F.struct("word", "k")).alias("_names"))
    rest = [f for f in rows.schema.fields if f.name not in (*block, "text")]
    ahead = lists.select(*block, *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest], F.lit(None).cast("array<string>").alias("_words"), "_names")
    turns = rows.select(*block, *[f.name for f in rest], T.tokens(F.col("text")).alias("_words"), F.lit(None).cast(ahead.schema["_names"].dataType).alias("_names"))
    laid = ahead.unionByName(turns).repartition(*block).sortWithinPartitions(*block, F.col("_names").isNull())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (*[rows.schema[c] for c in block], *rest))
    return laid.mapInArrow(lambda b: _renaming(block, POSITION)(b), f"{kinds}, text string").select(*rows.columns)


def cut_titles(rows: DataFrame) -> DataFrame:
    """Every turn up to the first end of a title in it."""
    return rows.withColumn("text", T.before_title_end(F.col("text")))


def segment_sizes(rows: DataFrame) -> DataFrame:
    """Turns per segment."""
    return rows.groupBy(*SEGMENT).agg(F.count("*").alias("turns"))


