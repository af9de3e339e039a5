"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of all training texts are gathered per language and bucket; the smoothed log-probabilities form one matrix, which
is broadcast after its size was fixed: the number of buckets is halved until buckets times languages stay below
``MATRIX_CELLS``.  Texts are scored in numpy, a slice of texts at a time.

Defined results: null texts and texts without a letter are ``und`` with score 0; rows with a null language are not learnt
from; ties go to the smaller language value; without any training row every text is ``und``; repeated rows are judged
one by one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import prepare, slices

BUCKETS, MATRIX_CELLS = 1 << 15, 1 << 24
NGRAMS = (1, 2, 3)
ALPHA = 0.5
UNDETERMINED = "und"
_MULT = np.uint32(0x9E3779B1)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each between blanks, and where each text begins."""
    joined = "".join(f" {t.lower()} " for t in texts)
    sizes = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(sizes)])


def buckets_of(points: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each place."""
    h = np.full(len(points) - n + 1, n, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * _MULT
            h ^= h >> np.uint32(15)
    return (h & np.uint32(buckets - 1)).astype(np.int32)


def _size(languages: int) -> int:
    size = BUCKETS
    while size > 256 and size * languages > MATRIX_CELLS:
        size //= 2
    return size


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, prior: np.ndarray) -> None:
        self.languages, self.table, self.prior = languages, table, prior  # table: buckets x languages

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Most likely language of each text and its share of the likelihood per n-gram."""
        points, at = code_points(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for n in NGRAMS:
            values = self.table[buckets_of(points, n, len(self.table))]
            ends = np.maximum(at[1:] - n + 1, at[:-1])
            cuts = np.stack([at[:-1], ends], axis=1).ravel()
            total += np.add.reduceat(np.concatenate([values, np.zeros((n, values.shape[1]), values.dtype)]), np.minimum(cuts, len(values)), axis=0, dtype=np.float64)[::2]
        total += self.prior
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        return [self.languages[i] for i in best], 1 / share.sum(axis=1)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from every row outside the held-out part that has a language."""
    prepare(docs.sparkSession)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    per = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(per)
    size = _size(len(languages))
    if not languages:
        return Model([], np.zeros((size, 0), np.float32), np.zeros(0))
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), size), np.int64)
        for whole in batches:
            for b in slices(whole):
                langs = np.array([place[x] for x in b.column(0).to_pylist()])
                texts = b.column(1).to_pylist()
                for k in np.unique(langs):
                    points, _ = code_points([t for t, x in zip(texts, langs, strict=True) if x == k])
                    for n in NGRAMS:
                        counts[k] += np.bincount(buckets_of(points, n, size), minlength=size)
        k, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[k, bucket])], ["lang", "bucket", "n"])

    found = known.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(count, "lang int, bucket int, n long")
    table = np.full((size, len(languages)), ALPHA)
    for r in found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False):
        table[r.bucket, r.lang] += r.n
    prior = np.log(np.array([per[x] for x in languages]) / sum(per.values()))
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32), prior)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.when(text.rlike(r"\p{L}"), text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for b in slices(whole):
                texts = b.column(1).to_pylist()
                langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                have = [i for i, t in enumerate(texts) if t is not None] if model.languages else []
                if have:
                    best, score = model.judge([texts[i] for i in have])
                    scores[have] = score
                    for i, x in zip(have, best, strict=True):
                        langs[i] = x
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    got = predict(docs, fit(docs))
    return got.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
