"""Registered queries of the dealt operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswash.llm import alignment, ann, chat, decontam, html_text, langid, licenses, mixing, phrases, simhash, token_codes, toxicity, urls


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def with_paths(docs: DataFrame) -> DataFrame:
    """Documents have no path: source, language and shard of the id make a tree of one to three levels."""
    depth, name = F.pmod("doc_id", F.lit(3)), F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    folders = [F.coalesce(c, F.lit("unknown")) for c in (F.col("source"), F.col("lang"))]
    shard = F.concat(F.lit("p"), F.pmod("doc_id", F.lit(50)).cast("string"))
    return docs.withColumn("path", F.when(depth == 0, F.concat_ws("/", folders[0], name)).when(depth == 1, F.concat_ws("/", *folders, name)).otherwise(F.concat_ws("/", *folders, shard, name)))


def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(with_paths(_table(spark, sf, "documents")))


def op2_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    got = urls.judged(pages, urls.labelled_by_rules(pages))
    return got.withColumnRenamed("id", "page_id")


def op3_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.digests(rows.unionByName(more))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(_table(spark, sf, "documents"))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    got = simhash.classes(_table(spark, sf, "documents"))
    return got.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return token_codes.token_ids(_table(spark, sf, "documents"), tokenizer_path())


def op9_langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.report(_table(spark, sf, "documents"))


def op10_decontam(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


def op12_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(_table(spark, sf, "pages")).withColumnRenamed("id", "page_id")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(_table(spark, sf, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
