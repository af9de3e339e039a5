"""Instances files of any size: one JSON document, read by many tasks.

The file is split at closing braces, which Spark's line reader does for any byte range; so a range that begins inside a
string, an escape or a nested object goes on at the next brace.  What a piece means depends on the text before it: whether
it begins inside a string, and how deep in braces.  Both are sums over the pieces before, carried from range to range by one
small row per range.  A piece cannot begin inside an escape, as ``\\}`` is none in JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuswash.functions import text as T
from corpuswash.plans.scale import SALTS, fits_broadcast, stored

#: What stands outside strings before the next opening brace.
_OUTSIDE = r'(?:[^"{]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+'


def _quotes(plain: Column) -> Column:
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def _braces(plain: Column, parity: int) -> Column:
    """Opening braces outside strings, if the piece begins outside (0) or inside (1) a string."""
    outside = F.filter(F.split(plain, '"', -1), lambda x, i: i % 2 == parity)
    return F.aggregate(outside, F.lit(0), lambda n, x: n + F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit(""))))


def _summed_before(rows: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over all pieces of the file before this one.

    Within a range by a window, across ranges by a window over one row per range.
    """
    at = ["file", "block"]
    per = rows.groupBy(*at).agg(F.sum(value).alias("_s"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*at, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    own = Window.partitionBy(*at).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_o", F.coalesce(F.sum(value).over(own), F.lit(0)))
    per = F.broadcast(per) if fits_broadcast(per) else per
    return placed.join(per, at).withColumn(out, F.col("_o") + F.col("_b")).drop("_o", "_b")


def pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, seq, value, inside, depth, opens, closes): the files cut behind every closing brace.

    ``inside`` tells whether the piece begins in a string, ``depth`` how many braces are open there, ``opens`` counts the
    opening braces of the piece, ``closes`` is 1 if the brace behind it closes one.
    """
    lines = spark.read.option("lineSep", "}").text(paths)
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    rows = rows.select("*", T.let(plain, lambda p: F.struct(_quotes(p).alias("quotes"), _braces(p, 0).alias("out"), _braces(p, 1).alias("in"))).alias("_p"))
    rows = stored(rows.select("file", "block", "seq", "value", (F.col("_p.quotes") % 2).alias("odd"), F.col("_p.out").alias("out"), F.col("_p.in").alias("in")))
    rows = _summed_before(rows, "odd", "_q").withColumn("inside", F.col("_q") % 2 == 1)
    rows = rows.withColumn("opens", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")))
    rows = rows.withColumn("closes", ((F.col("_q") + F.col("odd")) % 2 == 0).cast("int"))
    rows = rows.withColumn("_d", F.col("opens") - F.col("closes"))
    return _summed_before(rows, "_d", "depth").select("file", "block", "seq", "value", "inside", "depth", "opens", "closes")


def objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, number, head, json): the objects directly below the document's, and what stands before each."""
    rows = pieces(spark, paths)
    # an object below the document's is complete when a brace brings the depth back to 1
    rows = rows.withColumn("_done", ((F.col("closes") == 1) & (F.col("depth") + F.col("opens") == 2)).cast("long"))
    rows = _summed_before(stored(rows), "_done", "number").where(F.col("depth") + F.col("opens") >= 2)
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "value", "inside", "depth")))
    whole = rows.groupBy("file", "number").agg(parts.alias("p"))
    first = F.get("p", F.lit(0))
    text = F.concat(F.when(first["inside"], '"').otherwise(""), F.array_join(F.transform("p", lambda x: x["value"]), "}"), F.lit("}"))
    head = F.when(first["depth"] == 0, F.regexp_extract(text, rf"(?s)^{_OUTSIDE}\{{{_OUTSIDE}", 0)).otherwise(F.regexp_extract(text, f"(?s)^{_OUTSIDE}", 0))
    cut = whole.select("file", "number", text.alias("t"), head.alias("head"))
    return cut.select("file", "number", "head", F.expr("substring(t, length(head) + 1)").alias("json"))


def texts(spark: SparkSession, paths: str | list[str], array: str = "instances", field: str = "text") -> DataFrame:
    """(file, place, text): ``field`` of the objects in the document's ``array``; ``place`` counts from 0 in the array."""
    found = stored(objects(spark, paths))
    opening = F.regexp_extract("head", r'(?s)"((?:[^"\\]|\\.)*+)"\s*:\s*\[\s*$', 1)
    # a mark is an object that does not go on an array: the first of an array, or one that is no element
    marks = found.where(~F.rlike("head", F.lit(r"^\s*,\s*$"))).select("file", "number", (opening == array).alias("ours"), F.rlike("head", F.lit(r"\[\s*$")).alias("listed"))
    until = F.lead("number").over(Window.partitionBy("file").orderBy("number"))
    ours = marks.withColumn("until", until).where("ours and listed").select("file", F.col("number").alias("start"), "until")
    if fits_broadcast(ours):
        joined = found.join(F.broadcast(ours), "file")
    else:
        salted = found.withColumn("_salt", F.pmod("number", F.lit(SALTS)).cast("int"))
        joined = salted.join(ours.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["file", "_salt"])
    inside = joined.where((F.col("number") >= F.col("start")) & (F.col("until").isNull() | (F.col("number") < F.col("until"))))
    value = F.from_json("json", f"struct<`{field}`:string>")[field]
    return inside.select("file", (F.col("number") - F.col("start")).alias("place"), value.alias("text"))
