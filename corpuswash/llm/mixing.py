"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Every source gets a share of the budget by its weight.  Shares above ``max_epochs`` times the source are clamped, the
excess goes to the others by weight, until none is above.  A share of 1.3 times the source takes every document once and
a seeded 30 % of its words a second time: documents in the order of a hash until their sizes reach the rest.  Documents
larger than the rest are passed over, and what is missing at the border is filled from the documents behind it, in
``ROUNDS`` rounds; so a source falls short of its target by less than a small document, wherever its large ones come.

Defined results: a null text has size 0, a null source is a source of its own and comes last, null ids are ids of their
own; rows equal in id and text have equal hashes and are taken alike; sources without words get the target 0; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.llm.common import id_of, ranked, sized, stored
from corpuswash.plans.scale import lookup_join

WEIGHTS = (3, 1, 2)
BUDGET, MAX_EPOCHS, SEED = 1.5, 2.0, 17
#: Levels of the hash, in bits, at which the border of the fractional sample is searched.
LEVELS = (12, 12)
ROUNDS = 3
HASH_BITS = 60


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_: Column, text: Column, seed: int = SEED) -> Column:
    """60 bits of MD5 of id, seed and text."""
    name = F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(f":{seed}:"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source (source, known, source_size)."""
    order = ranked(sizes, ["known", "source"], "place")
    own = F.array(*[F.lit(float(w)) for w in weights])[F.pmod("place", F.lit(len(weights))).cast("int")]
    rows = order.select("source", "known", "source_size", own.alias("w"), (F.col("source_size") * max_epochs).alias("cap"))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * budget
    level = 0.0
    while True:
        # sources that the level fills are clamped; the rest of the budget is shared by the weights of the others
        full = F.col("w") * level >= F.col("cap")
        r = rows.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not r[1] or total <= r[0]:
            break
        new = (total - r[0]) / r[1]
        if new <= level:
            break
        level = new
    return rows.select("source", "known", "source_size", F.least("cap", F.col("w") * level).alias("target"))


def _border(level: DataFrame, rest: DataFrame) -> DataFrame:
    """(source, known, below) from rows (source, known, h, size) and (source, known, rest): rows whose hash lies below have
    sizes that add up to the rest at most, and the next one would pass it."""
    key, done = ["source", "known"], 0
    rest = rest.select(*key, "rest", F.lit(0).cast("long").alias("low"))
    for bits in LEVELS:
        # the slot of the hash in which the sum of sizes passes the rest; what lies below is taken
        done += bits
        slot = F.shiftright("h", HASH_BITS - done)
        sums = level.withColumn("slot", slot).groupBy(*key, "slot").agg(F.sum("size").alias("s"))
        run = F.sum("s").over(Window.partitionBy(*key).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        passed = sums.withColumn("upto", run).join(rest, key)
        edge = passed.where(F.col("upto") <= F.col("rest")).groupBy(*key).agg(F.max("upto").alias("upto"))
        at = passed.where(F.col("upto") > F.col("rest")).groupBy(*key).agg(F.min("slot").alias("slot"))
        rest = stored(rest.join(edge, key, "left").join(at, key, "left").select(*key, (F.col("rest") - F.coalesce("upto", F.lit(0))).alias("rest"), F.coalesce(F.col("slot") * (1 << (HASH_BITS - done)), F.lit(1 << HASH_BITS)).alias("low"), F.coalesce("slot", F.lit(-1)).alias("slot")))
        level = lookup_join(level, rest.select(*key, F.col("slot").alias("in_slot")), key, "inner", ["h"]).where(slot == F.col("in_slot")).drop("in_slot")
        rest = rest.drop("slot")
    last = Window.partitionBy(*key).orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = level.withColumn("upto", F.sum("size").over(last)).join(rest, key).where(F.col("upto") <= F.col("rest")).groupBy(*key).agg((F.max("h") + 1).alias("tail"))
    return stored(rest.select(*key, "low").join(tail, key, "left").select(*key, F.coalesce("tail", "low").alias("below")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, h, size, source, source_size, target, copies): one row per document row; ``h`` is its draw."""
    text, source = F.col(text_col), F.col(source_col).cast("string")
    sized = stored(
        docs.select(id_of(id_col).alias("id"), draw(F.col(id_col), text, seed).alias("h"), n_words(text).alias("size"), F.coalesce(source, F.lit("")).alias("source"), source.isNull().cast("int").alias("known"))
    )
    key = ["source", "known"]
    per = targets(sized.groupBy(*key).agg(F.sum("size").alias("source_size")), weights, budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = stored(per.withColumn("whole", F.floor(epochs)).withColumn("rest0", F.col("target") - F.col("whole") * F.col("source_size")))
    again = F.lit(False)
    for i in range(ROUNDS):
        # rows that no round has taken and that fit into what is still missing
        open_ = lookup_join(sized, plan, key, "inner", ["h"]).where(~again & (F.col("size") <= F.col(f"rest{i}")))
        below = _border(open_.select(*key, "h", "size"), plan.select(*key, F.col(f"rest{i}").alias("rest")))
        plan = stored(plan.join(below, key).withColumnRenamed("below", f"below{i}"))
        again = again | ((F.col("size") <= F.col(f"rest{i}")) & (F.col("h") < F.col(f"below{i}")))
        if i + 1 < ROUNDS:
            got = lookup_join(sized, plan, key, "inner", ["h"]).where(again).groupBy(*key).agg(F.sum("size").alias("got"))
            plan = stored(plan.join(got, key, "left").withColumn(f"rest{i + 1}", F.col("rest0") - F.coalesce("got", F.lit(0))).drop("got"))
    joined = lookup_join(sized, plan, key, "inner", ["h"])
    copies = F.col("whole") + F.when(again, 1).otherwise(0)
    return joined.select("id", "h", "size", F.when(F.col("known") == 0, F.col("source")).alias("source"), "source_size", "target", copies.cast("long").alias("copies"))


def report(docs: DataFrame, **how: object) -> DataFrame:
    return mix(docs, **how).select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", seed: int = SEED, **how: object) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; documents taken zero times are left out."""
    taken = mix(docs, id_col=id_col, seed=seed, **how).groupBy("id", "h", "source").agg(F.min("copies").alias("__copies"))
    h = draw(F.col(id_col), F.col(how.get("text_col", "text")), seed)
    key = docs.withColumn("__id", id_of(id_col)).withColumn("__h", h).withColumn("__s", F.coalesce(F.col(how.get("source_col", "source")).cast("string"), F.lit("\0")))
    count = taken.select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.coalesce("source", F.lit("\0")).alias("__s"), "__copies")
    joined = key.join(sized(stored(count)), ["__id", "__h", "__s"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).where("__copies > 0").select(*docs.columns)
