"""The utterance rules on an unbounded input.

Every rule looks at one utterance, so the chain runs unchanged on a stream and keeps no state.
Session and corpus passes need whole sessions and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpuswash.operators.rowchain import apply_rules, prepare
from corpuswash.operators.rules import BACK_RULES, FINAL_STRIP, FRONT_RULES
from corpuswash.plans.config import CleanConfig


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


#: Rules that look beyond one utterance, at a word list or at its tokens.
NOT_STREAMED = (
    "no_utter_dup", "re_name", "split_multi_repost", "no_toupiao", "no_short_response", "no_ad", "de_generic_dialog",
    "no_special_topic", "no_str_blacklist", "no_alpha_noise", "check_confuse_word", "no_word_blacklist", "yda_dedupl",
)


def clean_stream(rows: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Non-empty utterances after the utterance rules of ``cfg``; other rules that are on are refused."""
    refused = [f for f in NOT_STREAMED if getattr(cfg, f)]
    if refused:
        raise ValueError(f"not on a stream: {', '.join(refused)}; switch them off and run them as a batch job")
    chosen = [r for r in (*FRONT_RULES, *BACK_RULES) if r.flag is None or getattr(cfg, r.flag)]
    out = apply_rules(prepare(rows, audit=False), [*chosen, FINAL_STRIP])
    return out.drop("orig").where(F.col("text") != "")


def append_parquet(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; the file sink and the checkpoint give exactly-once output."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
