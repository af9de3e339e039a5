"""Helpers that the operators share: stored intermediates, ranks, components, byte-bounded batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuswash.plans.scale import fits_broadcast
from corpuswash.plans.workers import send

LOWEST = -(1 << 63)
BATCH_ROWS = 512
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, since whole texts are long; and this package for the workers."""
    send(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="corpuswash-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/corpuswash-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write as Parquet into the shared folder and read back: a cut of the lineage that survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(table: DataFrame) -> DataFrame:
    """Broadcast after its rows and bytes were counted, joined by a shuffle beyond the bound; for keys that are not hot."""
    return F.broadcast(table) if fits_broadcast(table) else table


def id_of(name: str) -> Column:
    """An id that is never null: null ids count as one id of their own, below all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LOWEST))


_KEPT: dict[Hashable, tuple[int, object]] = {}


def _stage() -> int:
    task = TaskContext.get()
    return -1 if task is None else task.stageId()


def kept[T](name: Hashable, make: Callable[[], T]) -> T:
    """What a worker process remembers over its tasks, made when it is first asked for; see ``give_back``."""
    value = _KEPT[name][1] if name in _KEPT else make()
    _KEPT[name] = _stage(), value
    return value  # type: ignore[return-value]


def give_back() -> None:
    """Drop what tasks of other stages remember and return freed memory to the system: workers live on, and other stages
    need it.  Only glibc can trim its heap."""
    stage = _stage()
    for name in [x for x, (own, _) in _KEPT.items() if own != stage]:
        del _KEPT[name]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def slices(batch: pa.RecordBatch, column: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in ``column``; a longer single value stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield batch.slice(first)
    give_back()


def ranked(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number all rows from 0 in the order of ``by`` without gathering them in one task.

    The rows are range-partitioned and sorted; only the row count of each partition reaches the driver.
    The numbering is stored, so later reads see the same numbers.
    """
    spark = df.sparkSession
    parts = df.repartitionByRange(*by).sortWithinPartitions(*by)
    local = stored(parts.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    counts = {r["_part"]: r["n"] for r in local.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    start, rows = 0, []
    for part in sorted(counts):
        rows.append((part, start - (part << 33)))
        start += counts[part]
    shift = spark.createDataFrame(rows, "_part int, _shift long")
    return local.join(F.broadcast(shift), "_part").select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(name))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, root), root being the smallest node reachable.

    Alternates the two star operations (every larger neighbour, then every smaller one, is hung below the smallest
    neighbour) until nothing changes.  Minima are pre-aggregated, the joins back are plain equi-joins that AQE can split.
    """

    def mark(e: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first())

    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(cur)
    for _ in range(rounds if before[0] else 0):
        both = cur.select("a", "b").unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))))
        cur = stored(small.where("a <> b").distinct())
        now = mark(cur)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))


def numbered(df: DataFrame, part: list[str], order: list[Column], name: str) -> DataFrame:
    """Row number within small groups; the caller bounds the groups."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
