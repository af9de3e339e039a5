"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs (1: block), at most ``SAMPLE`` of them, chosen by a hash.  Features: lengths, depth,
digit and punctuation shares, entropy, parameter counts and the smoothed label rates of the host's endings.

Defined results: null urls and urls without ``://`` have an empty host and path, fit no rule and are judged by the
features of an empty host; null labels are not learnt from; repeated rows are judged one by one; equally long rules go by
their text; without labels of both classes the share of blocked labels decides; extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import stored
from corpuswash.plans.scale import lookup_join

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
SAMPLE = 20_000
TREES, DEPTH, CUT = 20, 4, 0.5
SMOOTH = 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBERS = ["len_url", "len_host", "len_path", "len_query", "depth", "labels", "digits", "host_digits", "hyphens", "host_hyphens", "params", "entropy", "longest_label", "secure", "fragment", "rate_suffix", "rate_domain"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of the contract."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = None, None
    for text, what in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, way = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + way)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule.otherwise(none), verdict.otherwise(none))


def features(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path) with the lexical features; the rates come from ``rates``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    share = lambda text, kind: F.when(F.length(text) > 0, (F.length(text) - F.length(F.regexp_replace(text, kind, ""))) / F.length(text)).otherwise(0.0)
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(F.length(c) > 0, n - F.length(F.replace(url, c, F.lit("")))).otherwise(0).cast("double"))
    entropy = F.when(n > 0, F.log2(n) - F.aggregate(counts, F.lit(0.0), lambda s, c: s + F.when(c > 0, c * F.log2(c)).otherwise(0.0)) / n).otherwise(0.0)
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    made = {
        "len_url": n,
        "len_host": F.length("host"),
        "len_path": F.length("path"),
        "len_query": F.length(query),
        "depth": F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit(""))),
        "labels": F.size(labels),
        "digits": share(url, "[0-9]"),
        "host_digits": share(F.col("host"), "[0-9]"),
        "hyphens": share(url, "[-_]"),
        "host_hyphens": F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit(""))),
        "params": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
        "entropy": entropy,
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "secure": F.lower(url).startswith("https"),
        "fragment": F.instr(url, "#") > 0,
    }
    keys = {"suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2)}
    return rows.select("*", *[c.cast("double").alias(k) for k, c in made.items()], *[c.alias(k) for k, c in keys.items()])


def rates(train: DataFrame, key: str, base: float) -> DataFrame:
    """Smoothed share of blocked urls per ending."""
    return train.groupBy(key).agg(((F.sum("y") + SMOOTH * base) / (F.count("*") + SMOOTH)).alias(f"rate_{key}"))


def judged(pages: DataFrame, labelled: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of every page; ``labelled`` has (url, y)."""

    def shaped(df: DataFrame, *keep: str) -> DataFrame:
        df = df.select(*keep, F.col(url_col).cast("string").alias("url") if url_col in df.columns else F.col("url").cast("string"))
        host, path = parts(F.col("url"))
        return features(df.select(*keep, "url", host.alias("host"), path.alias("path")))

    known = labelled.where(F.col("y").isin(0, 1)).orderBy(F.xxhash64("url"), "url", "y").limit(sample)
    train = stored(shaped(known, "y"))
    counted = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    base = counted.get(1, 0) / max(1, sum(counted.values()))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = shaped(pages.withColumnRenamed(id_col, "id"), "id")
    if len(counted) < 2:
        own = F.lit("block" if base >= CUT else "allow")
        return rows.select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.lit(base).alias("score"))
    for key in ("suffix", "domain"):
        table = stored(rates(train, key, base))
        train = train.join(table, key, "left")
        rows = lookup_join(rows, table, [key], "left", ["url"])
    assembler = VectorAssembler(inputCols=NUMBERS, outputCol="features")
    ready = lambda df: assembler.transform(df.fillna(base, ["rate_suffix", "rate_domain"]))
    trees = GBTClassifier(featuresCol="features", labelCol="y", maxIter=TREES, maxDepth=DEPTH, seed=7, checkpointInterval=-1, maxBins=32, minInstancesPerNode=10)
    model = trees.fit(ready(stored(train.coalesce(1))).select("features", F.col("y").cast("double").alias("y")))
    got = model.transform(ready(rows)).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= CUT, "block").otherwise("allow")
    return got.select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url_col: str = "url") -> DataFrame:
    """(url, y): the urls that a rule judges are the labelled ones; the trees carry these judgements to the rest."""
    rows = pages.select(F.col(url_col).cast("string").alias("url"))
    host, path = parts(F.col("url"))
    _, verdict = ruled(host, path, rules)
    return rows.select("url", verdict.alias("v")).where("v is not null").select("url", (F.col("v") == "block").cast("int").alias("y"))
