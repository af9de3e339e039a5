"""Ordered scans over sessions that may be arbitrarily long.

A session is cut into blocks of ``BLOCK_TURNS`` turns.  Windows and folds run per
``(session, block)``, so no task ever sees more of one session than a block; what a block needs
to know about the blocks before (or after) it is one small summary row per block, combined
per session and joined back.  Tables whose turns all lie in block 0 skip the carry step:
whether that holds is one aggregate over the ``turn`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.model import POSITION, SESSION

BLOCK_TURNS = 1024


def with_block(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    block = F.floor(F.col("turn") / block_turns).cast("long")
    return rows.withColumn("block", F.coalesce(block, F.lit(0).cast("long")))


def is_long(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> bool:
    """Does any session have turns outside block 0 (negative ones included)?"""
    low, top = rows.agg(F.min("turn"), F.max("turn")).first()
    return top is not None and (top >= block_turns or low < 0)


def block_window(key: list[str]) -> Window:
    return Window.partitionBy(*key, "block").orderBy(*POSITION)


def facts_by(rows: DataFrame, key: list[str], *aggs: Column) -> DataFrame:
    """Aggregate per ``key``, with the range of blocks it covers."""
    return rows.groupBy(*key).agg(*aggs, F.min("block").alias("min_block"), F.max("block").alias("max_block"))


def join_facts(rows: DataFrame, facts: DataFrame, key: list[str], how: str, long: bool) -> DataFrame:
    """Attach one fact row per ``key`` to the rows of that key.

    In long sessions the fact is repeated for every block that its key has, so the join runs per
    block as well; turn numbers may lie far apart.
    """
    if not long:
        return rows.join(facts.drop("min_block", "max_block"), key, how)
    spread = rows.select(*key, "block").distinct().join(facts.drop("min_block", "max_block"), key)
    return rows.join(spread, [*key, "block"], how)


def _long_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    longs = rows.where("block <> 0").select(*key).distinct()
    return rows.join(longs, key, "left_semi")


def running_sum(rows: DataFrame, value: Column, out: str, long: bool, key: list[str] = SESSION) -> DataFrame:
    """Sum of ``value`` over the rows before the current one."""
    w = block_window(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_v", value)
    local = rows.withColumn(out, F.coalesce(F.sum("_v").over(w), F.lit(0).cast("long")))
    if not long:
        return local.drop("_v")
    across = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        _long_rows(rows, key)
        .groupBy(*key, "block")
        .agg(F.sum("_v").alias("_s"))
        .select(*key, "block", F.sum("_s").over(across).alias("_carry"))
    )
    joined = local.join(carry, [*key, "block"], "left")
    return joined.withColumn(out, F.col(out) + F.coalesce("_carry", F.lit(0))).drop("_v", "_carry")


def previous_text(rows: DataFrame, out: str, long: bool, key: list[str]) -> DataFrame:
    """Text of the row before the current one in the same ``key``; null for the first."""
    w = block_window(key)
    local = rows.withColumn(out, F.lag("text").over(w))
    if not long:
        return local
    across = Window.partitionBy(*key).orderBy("block")
    carry = (
        _long_rows(rows, key)
        .groupBy(*key, "block")
        .agg(F.max_by("text", F.struct(*POSITION)).alias("_last"))
        .select(*key, "block", F.lag("_last").over(across).alias("_carry"))
    )
    first = F.row_number().over(w) == 1
    local = local.withColumn("_first", first)
    return (
        local.join(carry, [*key, "block"], "left")
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
        .drop("_first", "_carry")
    )


def next_known(rows: DataFrame, value: Column, out: str, long: bool, key: list[str] = SESSION) -> DataFrame:
    """First non-null ``value`` at the current row or after it; null if none follows."""
    w = block_window(key).rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("_v", value)
    local = rows.withColumn(out, F.first("_v", ignorenulls=True).over(w))
    if not long:
        return local.drop("_v")
    across = Window.partitionBy(*key).orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    carry = (
        _long_rows(rows, key)
        .groupBy(*key, "block")
        .agg(F.min_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*POSITION))).alias("_s"))
        .select(*key, "block", F.first("_s", ignorenulls=True).over(across).alias("_carry"))
    )
    joined = local.join(carry, [*key, "block"], "left")
    return joined.withColumn(out, F.coalesce(out, "_carry")).drop("_v", "_carry")


def cut_pieces(rows: DataFrame, hit: Column, gap: int, long: bool, key: list[str]) -> DataFrame:
    """Pieces left after the cuts of ``mark_pieces``, numbered by ``piece``."""
    out = mark_pieces(rows, hit, gap, long, key)
    return out.where(~F.col("_cut") & ~F.col("_alone")).drop("_hit", "_cut", "_fresh", "_alone")


def mark_pieces(rows: DataFrame, hit: Column, gap: int, long: bool, key: list[str]) -> DataFrame:
    """Cut every ``key`` at hits that come more than ``gap`` rows after the piece start.

    The row of a cut is removed, the next row starts a new piece; a hit closer to the piece
    start stays; a last piece of a single row is removed.  Adds ``piece`` (cuts before the row)
    and the flags ``_hit``, ``_cut``, ``_fresh`` (starts a piece) and ``_alone`` (is a last
    piece by itself).

    The only memory of the scan is the distance to the piece start, and only values up to
    ``gap + 1`` differ.  A block is therefore a map from entry state to exit state.  Short
    sessions enter block 0 in state 0; for long ones the maps are composed block after block to
    find every entry state.
    """
    top = gap + 1
    rows = rows.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    payload = [c for c in rows.columns if c not in (*key, *POSITION, "block")]
    packed = rows.groupBy(*key, "block").agg(
        F.array_sort(F.collect_list(F.struct(*POSITION, *payload))).alias("_x")
    )

    def advance(state: Column, is_hit: Column) -> Column:
        return F.when(is_hit & (state > gap), F.lit(0)).otherwise(F.least(state + 1, F.lit(top)))

    if long:
        exits = F.array(
            *[F.aggregate("_x", F.lit(s), lambda st, r: advance(st, r["_hit"])) for s in range(top + 1)]
        )
        maps = (
            _long_rows(rows, key)
            .groupBy(*key, "block")
            .agg(F.array_sort(F.collect_list(F.struct(*POSITION, "_hit"))).alias("_x"))
            .select(*key, "block", exits.alias("_map"))
        )
        last = F.max("block").over(Window.partitionBy(*key))
        entry = _entry_states(maps, key, top + 1).withColumn("_end", F.col("block") == last)
        packed = packed.join(entry, [*key, "block"], "left")
        packed = packed.withColumn("_entry", F.coalesce("_entry", F.lit(0)))
        packed = packed.withColumn("_end", F.coalesce("_end", F.lit(True)))
    else:
        packed = packed.withColumn("_entry", F.lit(0)).withColumn("_end", F.lit(True))

    start = F.struct(F.col("_entry").alias("st"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("cuts"))

    def step(acc: Column, r: Column) -> Column:
        cut = r["_hit"] & (acc["st"] > gap)
        return F.struct(
            advance(acc["st"], r["_hit"]).alias("st"),
            (acc["i"] + 1).alias("i"),
            F.when(cut, F.concat(acc["cuts"], F.array(acc["i"]))).otherwise(acc["cuts"]).alias("cuts"),
        )

    packed = packed.withColumn("_cuts", F.aggregate("_x", start, step, lambda a: a["cuts"]))
    packed = packed.withColumn("_n", F.size("_x"))
    out = packed.select(*key, "block", "_cuts", "_entry", "_end", "_n", F.posexplode("_x").alias("_i", "_r"))
    cut = F.array_contains("_cuts", F.col("_i"))
    fresh = F.when(F.col("_i") == 0, F.col("_entry") == 0).otherwise(F.array_contains("_cuts", F.col("_i") - 1))
    out = out.select(
        *key,
        "block",
        *[F.col("_r")[c].alias(c) for c in (*POSITION, *payload)],
        cut.alias("_cut"),
        fresh.alias("_fresh"),
        (fresh & F.col("_end") & (F.col("_i") == F.col("_n") - 1)).alias("_alone"),
    )
    return running_sum(out, F.col("_cut").cast("long"), "piece", long, key)


_FAN = 512


def _entry_states(maps: DataFrame, key: list[str], states: int) -> DataFrame:
    """Entry state of every block from the blocks' state maps.

    Composition is associative, so blocks are grouped by ``_FAN``, a group's composed map is
    computed, groups are grouped again, and the entry states come back down level by level.
    No group holds more than ``_FAN`` maps however many blocks a session has.
    """
    low_block, top_block = maps.agg(F.coalesce(F.min("block"), F.lit(0)), F.coalesce(F.max("block"), F.lit(0))).first()
    up = maps.withColumn("_up", F.floor((F.col("block") - low_block) / _FAN).cast("long"))
    listed = up.groupBy(*key, "_up").agg(F.array_sort(F.collect_list(F.struct("block", "_map"))).alias("_m"))

    def through(state: Column, m: Column) -> Column:
        return F.get(m["_map"], state)

    if top_block - low_block < _FAN:
        parents = listed.withColumn("_entry", F.lit(0))
    else:
        composed = listed.select(
            *key,
            F.col("_up").alias("block"),
            F.array(*[F.aggregate("_m", F.lit(s), through) for s in range(states)]).alias("_map"),
        )
        entry = _entry_states(composed, key, states).withColumnRenamed("block", "_up")
        parents = listed.join(entry, [*key, "_up"])
    entries = F.transform(
        "_m",
        lambda m, i: F.struct(
            m["block"].alias("block"),
            F.aggregate(F.slice("_m", 1, i), F.col("_entry"), through).alias("_entry"),
        ),
    )
    return parents.select(*key, F.explode(entries).alias("_e")).select(*key, "_e.block", "_e._entry")
