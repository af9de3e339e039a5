"""Approximate nearest neighbours along shifted space-filling curves.

Vectors are scaled to length one, projected to a few random directions, shifted, and ordered along a Hilbert curve; this
is done for several projections.  Each ordering is range-partitioned and numbered by Spark.  A query looks at the windows
around its place in every ordering, in blocks of equal size, and the finds are merged and ranked by the exact cosine.

The window is fitted, not fixed: for at most ``SAMPLE`` queries the true neighbours are found by brute force, and the
window is the distance along the nearest curve within which ``TARGET`` of them lie.  Every vector is indexed.

Equal vectors are one point with its smallest ids, so a vector that is repeated thousands of times fills no window.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; ties go to the smaller id; a repeated id counts as one row per vector; fewer candidates than k give all of them; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.llm.common import prepare, ranked, stored

K = 5
CURVES, DIMS, BITS = 16, 8, 6
BLOCK = 1024
#: Queries that a task compares with a block, and that are scored exactly at a time; what a rough cosine may be off by.
ASKERS, QUERIES, ROUNDING = 4096, 32, 1e-9
SAMPLE, TARGET = 64, 0.96
SEED = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points (rows x dims): Gray-code undo from the highest bit down."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def projections(size: int, curves: int = CURVES, dims: int = DIMS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (curves x size x dims) and shifts (curves x dims)."""
    rng = np.random.default_rng(seed)
    dims = min(dims, size)
    ways = np.stack([np.linalg.qr(rng.standard_normal((size, dims)))[0] for _ in range(curves)])
    return ways, rng.random((curves, dims))


def keys_of(vectors: np.ndarray, ways: np.ndarray, shifts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve keys (rows x curves) of vectors; coordinates of a unit vector spread as 1/sqrt(size)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.sqrt(vectors.shape[1])
    out = []
    for way, shift in zip(ways, shifts, strict=True):
        spread = 0.5 + np.arctan(unit @ way * scale) / np.pi  # roughly even over (0, 1), any length of tail
        out.append(hilbert(np.minimum(((spread + shift) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits))
    return np.stack(out, axis=1)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _best(queries: np.ndarray, qids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, cosine) of the k nearest rows of each query, ties to the smaller id.

    A matrix product finds the rows that may be among them: all that reach the k-th best but for rounding.  These are
    scored exactly, a few queries at a time, so that many equal cosines cost time and not memory.
    """
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(qids), QUERIES):
        asked = queries[at : at + QUERIES]
        near = (asked / np.linalg.norm(asked, axis=1, keepdims=True)) @ unit.T
        least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(asked), -2.0)
        qi, ri = np.nonzero(near >= least[:, None] - ROUNDING)
        score = cosines(asked[qi], rows[ri])
        order = np.lexsort((ids[ri], -score, qi))
        first = np.flatnonzero(np.diff(qi[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        order = order[place < k]
        out.append((qids[at + qi[order]], ids[ri[order]], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else column.tolist(), np.float64)


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def _truth(points: DataFrame, sample: list, k: int) -> DataFrame:
    """The k nearest points of a bounded list of queries, by brute force: a small top list per batch, then one merge."""
    qids, queries = np.array([r["rep"] for r in sample]), np.array([r["vec"] for r in sample], np.float64)
    sent = points.sparkSession.sparkContext.broadcast((qids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, queries = sent.value
        for b in batches:
            if b.num_rows:
                q, i, s = _best(queries, qids, _matrix(b.column(1)), b.column(0).to_numpy(), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], ["q", "rep", "score"])

    found = points.select("rep", "vec").mapInArrow(run, "q long, rep long, score double").where("q <> rep")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select("q", "rep")


def search(table: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = CURVES, block: int = BLOCK, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for every query row."""
    spark = table.sparkSession
    prepare(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    vec = F.col(vec_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["n"]
    rows = rows.where(F.size("vec") == dims)
    # the smallest k + 1 ids of each vector stand for all its copies
    few = rows.select("id", "vec").withColumn("place", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("place") <= k + 1)
    grouped = stored(few.groupBy("vec").agg(F.min("id").alias("rep"), F.array_sort(F.array_distinct(F.collect_list("id"))).alias("ids")))
    asking = stored(rows.where("asks").select("id", "vec").distinct().join(grouped.select("vec", "rep"), "vec").select("id", "rep"))
    ways, shifts = projections(dims, curves)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys_of(_matrix(b.column(1)), ways, shifts).tolist(), pa.list_(pa.int64()))], ["rep", "vec", "keys"])

    points = stored(grouped.select("rep", "vec").mapInArrow(keyed, "rep long, vec array<double>, keys array<long>"))
    n = points.count()
    order = ranked(points.select("rep", F.posexplode("keys").alias("curve", "key")), ["curve", "key", "rep"], "at")
    order = stored(order.select("curve", "rep", (F.col("at") - F.col("curve").cast("long") * n).alias("at")))
    askers = stored(asking.select("rep").distinct())
    probe = points.join(askers, "rep").orderBy(F.xxhash64("rep"), "rep").limit(sample).select("rep", "vec").collect()
    window = n
    if probe:
        truth = _truth(points, probe, k)
        own = order.select("curve", F.col("rep").alias("q"), F.col("at").alias("own"))
        gap = truth.join(order, "rep").join(own, ["curve", "q"]).groupBy("q", "rep").agg(F.min(F.abs(F.col("at") - F.col("own"))).alias("gap"))
        window = int(gap.agg(F.percentile("gap", F.lit(target))).first()[0] or 0) + 1
    blocks = -(-n // block)
    # a task looks at one block for at most about ``ASKERS`` queries; with more of them the block is dealt again per salt
    salts = max(1, -(-askers.count() * min(n, 2 * window + block) // (n * ASKERS)))
    data = order.join(points.select("rep", "vec"), "rep").select("curve", F.floor(F.col("at") / block).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "rep", "vec")
    first = F.greatest(F.floor((F.col("at") - window) / block), F.lit(0))
    last = F.least(F.floor((F.col("at") + window) / block), F.lit(blocks - 1))
    asks = order.join(askers, "rep").select("curve", "rep", F.explode(F.sequence(first, last)).alias("block")).join(points.select("rep", "vec"), "rep")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "rep": [], "score": []})
        q, i, s = _best(_matrix(left["vec"]), left["rep"].to_numpy(), _matrix(right["vec"]), right["rep"].to_numpy(), k + 1)
        return pd.DataFrame({"q": q, "rep": i, "score": s})

    asks = asks.toDF("rep", "curve", "block", "vec").withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    found = asks.groupBy("curve", "block", "salt").cogroup(data.groupBy("curve", "block", "salt")).applyInPandas(look, "q long, rep long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    found = found.dropDuplicates(["q", "rep"]).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    near = stored(found.join(grouped.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id")))
    # an asker needs the k + 1 best ids of its point: one may be its own
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1)
    answers = asking.select(F.col("id").alias("query_id"), F.col("rep").alias("q")).join(near, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
