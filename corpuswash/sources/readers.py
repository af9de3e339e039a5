"""Readers: files and tables to utterances, word lists to lexicon rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswash.functions import text as T
from corpuswash.model import to_utterances
from corpuswash.plans.scale import SPLIT_BYTES, ranked
from corpuswash.sources import instances as json_pieces

BOM = "\ufeff"


def _names(path: Column) -> list[Column]:
    """``dataset`` is the folder of a file, ``file_id`` its ``dataset_name`` without ``.jsonl``."""
    parts = F.split(path, "/")
    folder, name = F.url_decode(F.element_at(parts, -2)), F.url_decode(F.element_at(parts, -1))
    stem = F.regexp_replace(F.regexp_replace(name, r"\.gz$", ""), r"\.jsonl$", "")
    return [folder.alias("dataset"), F.concat_ws("_", folder, stem).alias("file_id")]


def _path_columns(df: DataFrame) -> DataFrame:
    return df.select(*_names(F.col("_metadata.file_path")), "*")


def _session_id() -> Column:
    """A unique number per line.  It depends on the file splits only, so a task that is run
    again after a lost executor numbers its lines the same way."""
    return F.monotonically_increasing_id()


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    df = _path_columns(spark.read.text(paths))
    value = F.regexp_replace(F.col("value"), f"^{BOM}", "")
    return df.select("dataset", "file_id", value.alias("value")).where(T.strip(F.col("value")) != "")


def _dialog_array(value: Column) -> Column:
    """The line as list of turns.  Anything but an array of strings is malformed: null."""
    is_list = F.rlike(T.strip(value), F.lit(r"(?s)^\[.*\]$"))
    parsed = F.from_json(value, "array<string>", {"mode": "PERMISSIVE"})
    return F.when(is_list, parsed)


def dialogues(spark: SparkSession, paths: str | list[str], have_id: bool = False) -> DataFrame:
    """JSON-lines dialogues (plain or ``.gz``): one array of turns per line.

    Blank and malformed lines are skipped, empty dialogues give no rows.  ``have_id`` reads
    ``[id, [turns]]`` lines.
    """
    lines = _lines(spark, paths)
    turns = _dialog_array(F.col("value"))
    if have_id:
        # the second element arrives as JSON text because the outer array holds strings
        turns = F.from_json(F.get(turns, 1), "array<string>")
    rows = lines.select("dataset", "file_id", _session_id().alias("session_id"), turns.alias("turns"))
    rows = rows.where(F.col("turns").isNotNull() & ~F.exists("turns", lambda t: t.isNull()))
    out = rows.select("dataset", "file_id", "session_id", F.posexplode("turns").alias("turn", "text"))
    return to_utterances(out, "session_id", "turn", "text", "dataset", "file_id")


def malformed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Skipped lines per file."""
    turns = _dialog_array(F.col("value"))
    bad = turns.isNull() | F.exists(turns, lambda t: t.isNull())
    return _lines(spark, paths).where(bad).groupBy("dataset", "file_id").agg(F.count("*").alias("lines"))


def instances(spark: SparkSession, paths: str | list[str], split: bool | None = None) -> DataFrame:
    """``{"type": ..., "instances": [{"text": ...}]}`` files: every non-blank text is a session.

    A file is one JSON document.  ``split`` reads it by many tasks (``sources/instances.py``); by default that is done as
    soon as one file is larger than a task's share.  Both ways give the same rows.
    """
    if split is None:
        split = _largest(spark, paths) > SPLIT_BYTES
    if split:
        found = json_pieces.texts(spark, paths)
        names = _names(F.col("file"))
        texts = found.select(*names, F.col("place").alias("session_id"), T.strip(F.col("text")).alias("text")).where("text != ''")
        return to_utterances(texts, "session_id", None, "text", "dataset", "file_id")
    schema = "type string, instances array<struct<text:string>>"
    files = _path_columns(spark.read.schema(schema).option("multiLine", True).json(paths))
    texts = files.select("dataset", "file_id", F.posexplode("instances").alias("session_id", "i"))
    texts = texts.select("dataset", "file_id", "session_id", T.strip(F.col("i.text")).alias("text")).where("text != ''")
    return to_utterances(texts, "session_id", None, "text", "dataset", "file_id")


def _largest(spark: SparkSession, paths: str | list[str]) -> int:
    """Bytes of the largest file."""
    jvm, conf, most = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        store = path.getFileSystem(conf)
        for status in store.globStatus(path) or []:
            own = store.listStatus(status.getPath()) if status.isDirectory() else [status]
            most = max([most, *(x.getLen() for x in own)])
    return most


def raw_tree(spark: SparkSession, root: str, dataset: str = "*") -> DataFrame:
    """The two-level tree ``root/<dataset>/<file>.{jsonl,json}``; ``dataset`` prunes the paths."""
    found = []
    for suffix, reader in (("jsonl", dialogues), ("jsonl.gz", dialogues), ("json", instances)):
        pattern = f"{root}/{dataset}/*.{suffix}"
        if _exists(spark, pattern):
            found.append(reader(spark, pattern))
    if not found:
        raise FileNotFoundError(f"no .jsonl or .json files under {root}/{dataset}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def _exists(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    matches = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return matches is not None and len(matches) > 0


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Stripped non-blank lines with their file."""
    lines = _lines(spark, paths)
    return lines.select("dataset", "file_id", T.strip(F.col("value")).alias("line"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon files, one word per line: ``(word, ord)``.

    ``ord`` counts the non-blank lines from 0 through all splits and files, files in the order
    of their paths.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        T.strip(F.col("value")).alias("word"),
    )
    return ranked(lines.where("word != ''"), ["file", "start", "line"], "ord").select("word", "ord")


def symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """Symbol vocabulary, ``symbol<TAB><TAB>count`` per line."""
    lines = word_list(spark, path)
    return lines.select(F.substring_index("word", "\t\t", 1).alias("word"), "ord")


def cleaned(spark: SparkSession, path: str) -> DataFrame:
    """All that ``writers.write_text`` wrote below ``path``: the lines and the oversized segments."""
    parts = [cleaned_text(spark, f"{path}/lines/*/*.txt")] if _exists(spark, f"{path}/lines/*/*.txt") else []
    if _exists(spark, f"{path}/oversized/*/*.json"):
        big = spark.read.schema("dataset string, file_id string, session_id long, segment string, turn long, part int, text string")
        rows = big.option("basePath", f"{path}/oversized").json(f"{path}/oversized/*/*.json")
        # a segment is a session here, as it is in the lines; ids of its own keep it apart from theirs
        session = F.xxhash64("dataset", "file_id", "session_id", "segment")
        at = F.struct("turn", "part")
        rows = rows.select("dataset", F.concat("file_id", F.lit("_oversized")).alias("file_id"), session.alias("session_id"), at["turn"].alias("turn"), "part", "text")
        parts.append(rows)
    if not parts:
        raise FileNotFoundError(f"nothing was written below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def cleaned_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Cleaned sessions read back: turns separated by two tabs."""
    lines = text_lines(spark, paths)
    rows = lines.select("dataset", "file_id", _session_id().alias("session_id"), F.split("line", "\t\t").alias("turns"))
    out = rows.select("dataset", "file_id", "session_id", F.posexplode("turns").alias("turn", "text"))
    return to_utterances(out, "session_id", "turn", "text", "dataset", "file_id")
