"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Texts are lower-cased and cut into windows of ``window_words`` words between border marks.  Each window is compressed
behind the ordinary dictionary and behind the toxic dictionary with the ordinary one; a window that the toxic dictionary
shortens by at least ``threshold`` bytes speaks for toxicity.  The threshold and the scores are calibrated on labelled
texts.  One-word windows give the widest gap: a longer one mixes the cost of its ordinary words into the difference.

Training reads at most ``SAMPLE`` labelled texts per class, chosen by a hash of the id.  The toxic dictionary is trained
on words that are ``LIFT`` times as frequent in toxic texts, at two standard errors and counted by the different words
before them, so that copies of one text count once; words that both classes share would fill it with ordinary text.
Beginnings of words count as words here, since compression finds them in words that it has not seen.

Defined results: null and empty texts score as a text without evidence; null labels and null ids are not learnt from;
repeated rows are scored one by one; without labels of both classes every score is the share of toxic labels (0 without
labels); extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpuswash.llm.common import kept, prepare, slices, stored

SAMPLE = 2500
WINDOW_WORDS = 1
TOXIC_WORDS, TOXIC_BYTES, ORDINARY_BYTES = 2000, 16 << 10, 16 << 10
LIFT, LEAST = 3.0, 3
STARTS = (4, 5, 6)
CUT = 0.3
MOST_GAIN = 8
#: Windows whose gain a worker remembers.
MEMORY = 400_000
#: Border marks, and bytes after the window: the last eight bytes of an input are never matched.
LEFT, RIGHT, AFTER = b"\x01\x02\x03", b"\x03\x02\x01", b"\n0123456789abcdef"

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def held_out(id_: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; false for null ids."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORD).split()


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[bytes]:
    """Runs of ``size`` words, without overlap; the last may be shorter."""
    words = words_of(text)
    return words if size == 1 else [b" ".join(words[i : i + size]) for i in range(0, len(words), size)]


def marked(window: bytes) -> bytes:
    return LEFT + window + RIGHT


class Judge:
    """The two compressors and the calibrated threshold; small enough to be sent with the task."""

    def __init__(self, toxic: bytes, ordinary: bytes, threshold: int = 0, weights: tuple[float, ...] = (), prior: float = 0.0) -> None:
        self.toxic, self.ordinary, self.threshold, self.weights, self.prior = toxic, ordinary, threshold, weights, prior
        self._made: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    def _both(self) -> tuple:
        if self._made is None:
            made = []
            for content in (self.ordinary, self.toxic + self.ordinary):
                how = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_BTOPT, min_match=4, target_length=64, search_log=8, window_log=17, hash_log=10, chain_log=15, write_content_size=False, write_checksum=False, write_dict_id=False)
                kind = zstandard.ZstdCompressionDict(content + AFTER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                kind.precompute_compress(compression_params=how)
                made.append(zstandard.ZstdCompressor(dict_data=kind, compression_params=how).compress)
            self._made = tuple(made)
        return self._made

    def gains(self, text: str | None) -> list[int]:
        """Bytes that the toxic dictionary saves in each window; a worker remembers windows it has seen in the stage."""
        plain, both = self._both()
        known: dict[bytes, int] = kept(("gains", self.toxic, self.ordinary), dict)
        cut = windows(text)
        new = {w for w in cut if w not in known}
        if new:
            if len(known) + len(new) > MEMORY:
                known.clear()
                new = set(cut)
            for w in new:
                line = marked(w) + AFTER
                known[w] = len(plain(line)) - len(both(line))
        return [known[w] for w in cut]

    def evidence(self, text: str | None, threshold: int | None = None) -> tuple[int, int, int]:
        g = self.gains(text)
        t = self.threshold if threshold is None else threshold
        return max(g, default=0), sum(x >= t for x in g), len(g)

    def score(self, text: str | None) -> float:
        if not self.weights:
            return self.prior
        most, n, _ = self.evidence(text)
        z = self.weights[0] + self.weights[1] * most + self.weights[2] * np.log1p(n)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained content; the samples themselves where they are too few to train on."""
    flat = b"".join(dict.fromkeys(samples))
    if len(flat) <= size:
        return flat
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return flat[:size]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge; few features, bounded rows."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Judge:
    """Train on labelled rows outside the held-out part; see the module text for the bound."""
    spark = docs.sparkSession
    prepare(spark)
    key = F.col(id_col).cast("long")
    known = labels.select(key.alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("id")) & F.col("id").isNotNull())
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    share = known.agg(F.avg("y")).first()[0] or 0.0
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    chosen = stored(chosen[0].unionByName(chosen[1]).coalesce(1))  # at most 2 * sample rows of two numbers
    texts = docs.select(key.alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = stored(texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"]))
    n = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Judge(b"", b"", prior=float(share))
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z0-9\x{80}-\x{10ffff}]+"), F.lit(0))
    pairs = texts.select("y", w.alias("w")).select("y", F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), F.expr("slice(w, 1, greatest(size(w) - 1, 0))")).alias("a"), F.col("w").alias("b"))).alias("p"))
    pairs = pairs.select("y", F.col("p.a").alias("before"), F.col("p.b").alias("w")).where("w is not null").distinct()
    starts = [F.when(F.length("w") > n, F.substring("w", 1, n)) for n in STARTS]
    pairs = pairs.select("y", "before", F.explode(F.array_compact(F.array(F.concat("w", F.lit("$")), *starts))).alias("word")).distinct()
    per = stored(pairs.groupBy("word").agg(F.sum("y").alias("tox"), F.sum(1 - F.col("y")).alias("ord")))
    total = per.agg(F.sum("tox").alias("tox"), F.sum("ord").alias("ord")).first()
    a, b = F.col("tox") + 0.5, F.col("ord") + 0.5
    least_lift = F.log(a / (total["tox"] + 1)) - F.log(b / (total["ord"] + 1)) - 2 * F.sqrt(1 / a + 1 / b)
    signs = per.where((least_lift >= float(np.log(LIFT))) & (F.col("tox") >= LEAST)).orderBy(F.desc("tox"), "word").limit(TOXIC_WORDS).collect()
    common = per.where("ord > 0").orderBy(F.desc("ord"), "word").limit(3 * TOXIC_WORDS).collect()
    toxic, ordinary = ([LEFT + r["word"].encode().replace(b"$", RIGHT) for r in rows] for rows in (signs, common))
    judge = Judge(_dictionary(toxic, TOXIC_BYTES), _dictionary(ordinary[::-1], ORDINARY_BYTES))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                gains = [np.sort(judge.gains(t))[::-1] for t in b.column(1).to_pylist()]
                tops = [[int(g[0]) if len(g) else 0, *[int((g >= t).sum()) for t in range(1, MOST_GAIN + 1)]] for g in gains]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tops, pa.list_(pa.int32()))], ["y", "top"])

    seen = texts.select("y", "text").mapInArrow(look, "y int, top array<int>").collect()
    y, top = np.array([r["y"] for r in seen], float), np.array([r["top"] for r in seen], float)
    balance = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))

    def f1(t: int) -> float:
        told = top[:, 0] >= t
        both = balance[told & (y == 1)].sum()
        return 2 * both / max(1e-9, balance[told].sum() + balance[y == 1].sum())

    threshold = max(range(1, MOST_GAIN + 1), key=lambda t: (f1(t), t))
    x = np.column_stack([np.ones(len(y)), top[:, 0], np.log1p(top[:, threshold])])
    w = _logistic(x, y)
    w[0] += np.log(max(share, 1e-6) / max(1 - share, 1e-6)) - np.log(y.mean() / (1 - y.mean()))
    return Judge(judge.toxic, judge.ordinary, threshold, tuple(float(v) for v in w), float(share))


def scored(docs: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``tox_score``; the text is read whole, in slices of bounded size."""
    prepare(docs.sparkSession)
    at, schema = docs.columns.index(text_col), StructType([*docs.schema.fields, StructField("tox_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, at):
                values = pa.array([judge.score(t) for t in b.column(at).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, values], [*b.schema.names, "tox_score"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, cut: float = CUT, **how: object) -> DataFrame:
    judge = fit(docs, labels, **how)
    digits = _digest(docs, judge)
    return digits.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("score"), (F.col("score") >= cut).cast("int").alias("predicted"))


def _digest(docs: DataFrame, judge: Judge) -> DataFrame:
    """(doc_id, score): texts do not come back from the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([judge.score(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, labels: DataFrame, cut: float = CUT, **how: object) -> DataFrame:
    """``docs`` without the rows that score ``cut`` or more; all columns stay."""
    return scored(docs, fit(docs, labels, **how)).where(F.col("tox_score") < cut).select(*docs.columns)
