"""Licence scans: sparse TF-IDF cosine of text units to licence templates, then inheritance along directories.

A unit is a line, or for longer lines every window of ``UNIT_WORDS`` words at half that step.  Document frequencies are
counted over all units; words outside the templates weigh as much as a word seen once.  A unit whose cosine to a template
is ``THRESHOLD`` or more gives its document that licence.  Most units are skipped exactly: template words are called
common, from the most frequent on, while they could not reach the threshold by themselves; a unit without any other
template word cannot reach it.

A document of which a licence unit makes up at least half counts as a licence file.  Documents without a licence of their
own inherit that of the nearest directory above (their own first) that holds a licence file.

Defined results: null and empty texts have no licence of their own; equal cosines go to the smaller licence name; of
several licence files in a directory the best cosine wins, then the smaller name; repeated rows are judged alike; a null
path lies in the top directory; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import id_of, sized, stored
from corpuswash.plans.scale import lookup_join

THRESHOLD, UNIT_WORDS = 0.75, 40
WORD = r"[A-Za-z0-9]+(?:\.[0-9]+)*"
#: Customary notices of common licences.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}


def words_of(text: str) -> list[str]:
    return [w.lower() for w in re.findall(WORD, text)]


def units(docs: DataFrame, key: list[str], text_col: str = "text", size: int = UNIT_WORDS) -> DataFrame:
    """(key..., all_chars, chars, words): one row per unit with words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = docs.select(*key, F.length(text).alias("all_chars"), F.explode(F.split(text, "\n")).alias("line"))
    words = lines.select(*key, "all_chars", F.length("line").alias("line_chars"), F.transform(F.regexp_extract_all("line", F.lit(WORD), F.lit(0)), F.lower).alias("line_words")).where(F.size("line_words") > 0)
    step = size // 2
    starts = F.when(F.size("line_words") <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size("line_words") - step - 1, F.lit(step)))
    cut = words.select(*key, "all_chars", "line_chars", F.size("line_words").alias("n"), "line_words", F.explode(starts).alias("start"))
    part = F.when(F.col("n") <= size, F.col("line_words")).otherwise(F.slice("line_words", F.col("start") + 1, F.lit(size)))
    return cut.select(*key, "all_chars", (F.col("line_chars") * F.least(F.lit(1.0), F.lit(float(size)) / F.col("n"))).alias("chars"), part.alias("words"))


class Weights:
    """IDF of the template words, and which of them are common (see the module text)."""

    def __init__(self, df: dict[str, int], n: int, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> None:
        self.tf = [(name, Counter(words_of(t))) for name, texts in sorted(templates.items()) for t in texts]
        terms = sorted({w for _, c in self.tf for w in c})
        self.unseen = math.log((1 + n) / 2) + 1
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in terms}
        self.norms = [math.sqrt(sum((c * self.idf[w]) ** 2 for w, c in tf.items())) for _, tf in self.tf]
        self.common: set[str] = set()
        for w in sorted(terms, key=lambda w: (-df.get(w, 0), w)):
            trial = self.common | {w}
            if any(math.sqrt(sum((c * self.idf[x]) ** 2 for x, c in tf.items() if x in trial)) >= threshold * m * (1 - 1e-9) for (_, tf), m in zip(self.tf, self.norms, strict=True)):
                break
            self.common = trial
        self.telling = [w for w in terms if w not in self.common]


def frequencies(parts: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> tuple[dict[str, int], int]:
    """Units with each template word, and all units; the words of the templates bound the result."""
    terms = sorted({w for texts in templates.values() for t in texts for w in words_of(t)})
    held = parts.select(F.explode(F.array_append(F.array_intersect("words", F.array(*map(F.lit, terms))), F.lit(""))).alias("word"))
    df = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return df, df.pop("", 0)


def similarity(parts: DataFrame, weights: Weights) -> DataFrame:
    """(unit, license, score): the best template of every unit that shares a word with one."""
    spark = parts.sparkSession
    idf = spark.createDataFrame(list(weights.idf.items()), "word string, idf double")
    held = [(w, i, c * weights.idf[w]) for i, (_, tf) in enumerate(weights.tf) for w, c in tf.items()]
    template = spark.createDataFrame(held, "word string, template int, weight double")
    names = spark.createDataFrame([(i, name, norm) for i, ((name, _), norm) in enumerate(zip(weights.tf, weights.norms, strict=True))], "template int, license string, norm double")
    words = parts.select("unit", F.explode("words").alias("word")).groupBy("unit", "word").agg(F.count("*").alias("tf"))
    words = words.join(F.broadcast(idf), "word", "left").withColumn("value", F.col("tf") * F.coalesce("idf", F.lit(weights.unseen)))
    length = words.groupBy("unit").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
    dot = words.join(F.broadcast(template), "word").groupBy("unit", "template").agg(F.sum(F.col("value") * F.col("weight")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm") / F.col("length"), 9)
    best = F.min(F.struct((-score).alias("minus"), "license"))
    found = dot.join(F.broadcast(names), "template").join(length, "unit").groupBy("unit").agg(best.alias("best"))
    return found.select("unit", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"))


def own_licenses(docs: DataFrame, key: list[str], text_col: str = "text", templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key..., license, score, is_file): documents with a licence of their own; rows of equal key are one."""
    parts = units(docs, key, text_col)
    weights = Weights(*frequencies(parts, templates), templates, threshold)
    if not weights.telling:
        weights.telling = sorted(weights.idf)
    near = stored(parts.where(F.arrays_overlap("words", F.array(*map(F.lit, weights.telling)))).withColumn("unit", F.monotonically_increasing_id()))
    scored = near.drop("words").join(similarity(near, weights).where(F.col("score") >= threshold), "unit")
    top = F.min(F.struct((-F.col("score")).alias("minus"), "license"))
    is_file = F.max(F.col("chars") * 2 >= F.col("all_chars"))
    return scored.groupBy(*key).agg(top.alias("top"), is_file.alias("is_file")).select(*key, F.col("top.license").alias("license"), (-F.col("top.minus")).alias("score"), "is_file")


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def ancestors(folder: Column) -> Column:
    """The folder itself, those above it, and the top, nearest first."""
    names = F.split(folder, "/")
    ups = F.transform(F.sequence(F.size(names), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(names, 1, i), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.array_append(ups, F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, license, how, score, license_dir): one row per document row; ``how`` is own, inherited or none."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    key = ["id", "path", "h"]
    rows = docs.select(id_of(id_col).alias("id"), path.alias("path"), F.xxhash64(text).alias("h"), text.alias("text"))
    own = stored(own_licenses(rows, key, "text", templates, threshold))
    files = own.where("is_file").select(parent(F.col("path")).alias("dir"), F.struct((-F.col("score")).alias("minus"), "license").alias("pick"))
    held = stored(files.groupBy("dir").agg(F.min("pick").alias("pick")).select("dir", F.col("pick.license").alias("dir_license")))
    small = stored(rows.select("id", "path", "h", parent(F.col("path")).alias("dir")))
    ups = small.select("dir").distinct().select("dir", F.posexplode(ancestors(F.col("dir"))).alias("up", "above"))
    met = lookup_join(ups, held.withColumnRenamed("dir", "above"), ["above"], "inner", ["dir"])
    nearest = stored(met.groupBy("dir").agg(F.min(F.struct("up", "above", "dir_license")).alias("n")).select("dir", F.col("n.above").alias("license_dir"), F.col("n.dir_license").alias("dir_license")))
    out = lookup_join(small.join(sized(own), key, "left"), nearest, ["dir"], "left", ["id"])
    how = F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none")
    return out.select(
        F.col("id").alias("doc_id"), "path", F.coalesce("license", "dir_license").alias("license"), how.alias("how"), F.round("score", 6).alias("score"), F.when(F.col("license").isNull(), F.col("license_dir")).alias("license_dir")
    )
