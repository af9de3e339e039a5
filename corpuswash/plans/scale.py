"""Decisions that depend on measured sizes: broadcast or not, checkpoint, session settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# a side is broadcast only when it was counted and stays under both bounds
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20
SALTS = 32
# a key with more rows than this is dealt over ``SALTS`` tasks
HOT_ROWS = 20_000
SPLIT_BYTES = 128 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the plans are written for.

    With ``requireAllClusterKeysForCoPartition`` off, joins on an utterance key reuse the
    partitioning by session block that the window steps need anyway.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` wins; a temporary folder is used only where a local session names
    none (tests).  On a cluster that would be another disk per executor, so it is refused.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpuswash-"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write as Parquet into the shared checkpoint folder and read back: a cut of the lineage in columns, which later
    reads may prune."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        checkpoint(spark.range(0))
    path = f"{sc.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number all rows from 0 in the order of ``by``.

    The rows are range-partitioned and sorted; only the row count of each partition reaches the
    driver, and the numbers are written, so that every later read sees the same ones.
    """
    parts = df.repartitionByRange(*by).sortWithinPartitions(*by)
    local = checkpoint(parts.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    counts = {r["_part"]: r["n"] for r in local.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for part in sorted(counts):
        starts.append((part, at - (part << 33)))
        at += counts[part]
    shift = df.sparkSession.createDataFrame(starts, "_part int, _shift long")
    return local.join(F.broadcast(shift), "_part").select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(name))


def fence(rows: DataFrame, computed: list[str]) -> DataFrame:
    """Keep filters above from being pushed into the expressions of ``computed``.

    Pushing ``text <> ''`` through a chain of rules would repeat the chain inside the filter,
    once per use of the text; a generated column is where that pushing stops.
    """
    rest = [c for c in rows.columns if c not in computed]
    packed = F.array(F.struct(*computed))
    return rows.select(*rest, F.inline(packed)).select(*rows.columns)


def shared(rows: DataFrame, by: list[str]) -> DataFrame:
    """Partition by ``by`` so that every use of the result reads one and the same shuffle.

    Column pruning would give each use its own, narrower shuffle and run everything below it
    again; packing the columns into one keeps the shuffles equal, and Spark reuses them.  The
    slice keeps ``inline`` from implying a filter on the packed column (see ``fence``).
    """
    rest = [c for c in rows.columns if c not in by]
    packed = rows.select(*by, F.array(F.struct(*rest)).alias("_row"))
    return packed.repartition(*by).select(*by, F.inline(F.slice("_row", 1, 1))).select(*rows.columns)


def spread(rows: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Use all cores for a small input.

    A file smaller than one split per core is read by a few tasks, or by one when it has a
    single row group, and the rules above are CPU-bound.  Such an input, and only such a one,
    is redistributed by its row key; a large input keeps its splits.
    """
    spark = rows.sparkSession
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    if size >= sc.defaultParallelism * SPLIT_BYTES:
        return rows
    return rows.repartition(sc.defaultParallelism, *by)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes (strings at their byte length, other columns at 8)."""
    size = F.lit(0)
    for name, kind in df.dtypes:
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(df: DataFrame) -> bool:
    rows, size = measure(df)
    return rows <= BROADCAST_ROWS and size + 64 * rows <= BROADCAST_BYTES


def by_frequency(table: DataFrame, count: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the largest ``count``, as many as may be broadcast, and the rest.

    Few keys make up most of a text.  Joined with the first part where they stand, nearly all rows need no shuffle, however
    long the table is.
    """
    levels = [1 << i for i in range(48)]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind == "string" else F.lit(8) for c, kind in table.dtypes), F.lit(64))
    above = [F.struct(F.count(F.when(F.col(count) >= x, 1)).alias("n"), F.coalesce(F.sum(F.when(F.col(count) >= x, size)), F.lit(0)).alias("b")) for x in levels]
    found = table.agg(F.array(*above).alias("at")).first()["at"]
    least = next((x for x, at in zip(levels, found, strict=True) if at["n"] <= BROADCAST_ROWS and at["b"] <= BROADCAST_BYTES), levels[-1])
    often = F.coalesce(F.col(count) >= least, F.lit(False))
    return table.where(often), table.where(~often)


def lookup_join(rows: DataFrame, table: DataFrame, on: list[str], how: str, salt_by: list[str]) -> DataFrame:
    """Join a large table with a lookup table whose keys may be hot.

    A lookup that was measured small is broadcast.  A larger one is shuffled; then the rows of
    one key are spread over ``SALTS`` tasks and the lookup is repeated once per salt, so a key
    that holds a third of all rows does not end in one task.
    """
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def skew_join(rows: DataFrame, table: DataFrame, on: list[str], how: str, salt_by: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join with a table of unique keys, of which only the counted hot ones are repeated per salt.

    For ``rows`` that are cheap to read twice: their keys are counted first.  There are at most rows / ``hot_rows`` hot
    keys; all other keys meet in a plain shuffle, so the table is not multiplied.
    """
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), on, how)
    hot = checkpoint(rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(*on, F.lit(SALTS).alias("_salts")))
    if hot.isEmpty():
        return rows.join(table, on, how)
    flags = F.broadcast(hot) if fits_broadcast(hot) else hot
    salts = F.coalesce("_salts", F.lit(1))
    salted = rows.join(flags, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int")).drop("_salts")
    spread = table.join(flags, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")
