"""Keep the texts a classifier calls inoffensive."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.plans.scale import by_frequency, checkpoint, stored

Scorer = Callable[[Column], Column]


def join_labels(texts: DataFrame, labels: DataFrame, on: str, label: str) -> DataFrame:
    return texts.join(labels.select(on, F.col(label).cast("double").alias("label")), on)


def class_counts(labelled: DataFrame, label: str = "label") -> DataFrame:
    return labelled.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("texts"))


def fit_offence_model(labelled: DataFrame, features: int = 1 << 14, iterations: int = 10) -> PipelineModel:
    """Hashed bag of words and logistic regression, fitted by Spark ML on ``(text, label)``."""
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="features", numFeatures=features),
        LogisticRegression(maxIter=iterations, regParam=0.01, labelCol="label"),
    ]
    return Pipeline(stages=stages).fit(labelled)


def score(texts: DataFrame, scorer: PipelineModel | Scorer) -> DataFrame:
    """Add ``prediction`` (0 inoffensive, 1 offensive) by a fitted model or by a caller's
    column function, for instance a pandas UDF."""
    if callable(scorer) and not hasattr(scorer, "transform"):
        return texts.withColumn("prediction", scorer(F.col("text")).cast("int"))
    out = scorer.transform(texts)
    return out.select(*texts.columns, F.col("prediction").cast("int").alias("prediction"))


def inoffensive(texts: DataFrame, scorer: PipelineModel | Scorer) -> DataFrame:
    return score(texts, scorer).where("prediction = 0").drop("prediction")


# ---- a scorer that plain SQL can state: token counts per class --------------

TOKEN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"


def _token_counts(texts: DataFrame, key: list[str]) -> DataFrame:
    tokens = texts.select(*key, F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("token"))
    return tokens.groupBy(*key, "token").agg(F.count("*").alias("n"))


def token_weights(labelled: DataFrame) -> tuple[DataFrame, float, float]:
    """Log-odds ``(token, weight)`` of each token of the labelled texts with add-one smoothing,
    the weight of any other token, and the log-odds of the classes.  Texts of one class only
    give no weights and a log-odds of zero."""
    counted, other, odds = _counted_weights(labelled)
    return counted.select("token", "weight"), other, odds


def _counted_weights(labelled: DataFrame) -> tuple[DataFrame, float, float]:
    """``token_weights`` with the number ``n`` of times that the labelled texts have the token."""
    n = (F.col("c0") + F.col("c1")).alias("n")
    words = _token_counts(labelled, ["label"])
    per = checkpoint(words.groupBy("token").agg(*[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(f"c{y}") for y in (0, 1)]))
    size = per.agg(F.count("*").alias("v"), F.coalesce(F.sum("c0"), F.lit(0)).alias("n0"), F.coalesce(F.sum("c1"), F.lit(0)).alias("n1")).first()
    texts = {r["label"]: r["texts"] for r in class_counts(labelled).collect()}
    if not texts.get(0.0) or not texts.get(1.0):
        return per.select("token", F.lit(0.0).alias("weight"), n), 0.0, 0.0
    room = [size["n0"] + size["v"], size["n1"] + size["v"]]
    weight = F.log((F.col("c1") + 1) / room[1]) - F.log((F.col("c0") + 1) / room[0])
    return per.select("token", weight.alias("weight"), n), math.log(max(1, room[0]) / max(1, room[1])), math.log(texts[1.0] / texts[0.0])


def counted_scores(texts: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    """``(key, offensive)``: is the sum of the token weights and the class log-odds above zero?

    Weights of frequent tokens are added up where the texts stand; of the other tokens a text sends each one once.
    """
    weights, other, odds = _counted_weights(labelled)
    often, seldom = by_frequency(weights, "n")
    tokens = texts.select(key, F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("token"))
    met = tokens.join(F.broadcast(often.select("token", "weight")), "token", "left")
    rest = F.when(F.col("weight").isNull(), F.col("token")).alias("rest")
    sums = stored(met.groupBy(key, rest).agg(F.sum("weight").alias("sum"), F.count("*").alias("n")))
    rare = sums.where("rest IS NOT NULL").join(seldom.select(F.col("token").alias("rest"), "weight"), "rest", "left")
    rare = rare.select(key, (F.col("n") * F.coalesce("weight", F.lit(other))).alias("sum"))
    total = sums.where("rest IS NULL").select(key, "sum").unionByName(rare).groupBy(key).agg(F.sum("sum").alias("total"))
    scored = texts.select(key).join(total, key, "left")
    return scored.select(key, (F.round(F.coalesce("total", F.lit(0.0)) + odds, 6) > 0).alias("offensive"))
