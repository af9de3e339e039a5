"""The corpus pipeline: toxic documents out, near copies out, benchmark passages out, sources mixed, token ids written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuswash.llm import decontam, mixing, simhash, token_codes, toxicity
from corpuswash.llm.common import stored
from corpuswash.llm.queries import tokenizer_path


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def not_copied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8 or more, by SimHash fingerprints split
    into blocks, joined on blocks and verified; pairs beyond the reach of these blocks by shared rare shingles."""
    return simhash.dedup(docs)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest of the token files, one row per document and repetition."""
    return token_codes.token_ids(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("near_duplicates", not_copied),
    ("decontamination", not_leaked),
    ("mixing", mixed),
    ("token_ids", tokens),
]
#: Compression lengths, SimHash and BPE are beyond SQL.  tests/llm hold near copies, decontamination, mixing and token files
#: against plain versions, toxicity by its accuracy on held-out rows, and the whole run on odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read as the next stage's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
