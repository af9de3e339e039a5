"""Segments on a stream equal those of a batch, for turns that arrive late and out of order."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpuswash.model import SESSION
from corpuswash.operators import blocks as B
from corpuswash.operators import sessions
from corpuswash.plans.scale import tune
from corpuswash.streaming.rowchain import append_parquet, read_stream
from corpuswash.streaming.sessions import segment_stream

SCHEMA = "dataset string, file_id string, session_id long, turn long, part int, text string, ts timestamp"
START = datetime(2024, 1, 1)


def made(seed):
    rng = random.Random(seed)
    rows = []
    for s in range(14):
        words = ["", "a", "long enough", "b ", "  c", "another turn"] if s % 4 else ["same text"]
        if s == 8:
            words = [""]
        for t in range(rng.randint(1, 14)):
            rows.append(("d", "f", s, t, 0, rng.choice(words), START + timedelta(seconds=20 * t + 7 * s)))
    return [*rows, rows[3]]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize(("dup", "short"), [(False, False), (True, True)])
def test_stream_equals_batch(spark, rocks, tmp_path, dup, short):
    tune(spark)
    rows = made(5)
    batch = B.with_block(spark.createDataFrame(rows, SCHEMA).drop("ts"))
    if dup:
        batch = sessions.drop_uniform(batch, False)[0]
    want = sorted(map(tuple, sessions.segment(batch, False, no_short_response=short).select(*SESSION, "segment", "turn", "part", "text").collect()))
    # arrival: up to a minute late, over several files, so in several micro-batches
    rng = random.Random(1)
    arriving = sorted(rows, key=lambda r: r[6] + timedelta(seconds=rng.randint(0, 60)))
    closing = ("z", "z", -1, 0, 0, "close", START + timedelta(days=2))
    last = [closing, (*closing[:3], 1, 0, "x", START + timedelta(days=4))]
    source = str(tmp_path / "in")
    cuts = [arriving[i : i + len(arriving) // 6 + 1] for i in range(0, len(arriving), len(arriving) // 6 + 1)]
    for part in [*cuts, last[:1], last[1:]]:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, max_files=1)
    out = segment_stream(stream, "ts", "2 minutes", dup, short)
    query = append_parquet(out, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert query.awaitTermination(240)
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).where(F.col("session_id") >= 0)
    assert sorted(map(tuple, got.collect())) == want
