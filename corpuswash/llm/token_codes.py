"""Token ids in directly addressable codes.

An id is cut into chunks of 8 bits.  Level 0 holds the lowest chunk of every id and one continuation bit; level k holds
the next chunk of those ids that go on.  A directory with the number of continuation bits before every 512th place turns
"where does id i go on" into one look-up and one popcount over at most 64 bytes, so any id is read without decoding others.

File: ``DAC1``, number of sections (u4), their lengths (u8), then the sections: document ids (i8), first place of each
document (u8, one more than documents), start of the file within its partition (u8), and for each level its chunks (u1),
continuation bits (u1, packed) and directory (u4); the last level has no bits.

Defined results: a null text is an empty one; an empty document holds only the end id; null document ids come first as
the lowest id; rows with equal ids are written one after the other in the order of their texts' first 32 characters, then
of a hash of the text; an empty table gives no file and no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import id_of, kept, prepare, shared_dir, slices, stored
from corpuswash.llm.pieces import ByteLevel as Encoder

CHUNK, STEP = 8, 512
MAGIC = b"DAC1"
END_ID = 2
#: Ids per file, about; a file is written and read as a whole by one task.
FILE_TOKENS = 4_000_000
#: Characters by which rows of one id are ordered; beyond them a hash decides.
HEAD = 32

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


# ---- codes ------------------------------------------------------------------


def encode(ids: np.ndarray) -> list[bytes]:
    """The sections of all levels."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        out.append((rest & 0xFF).astype(np.uint8).tobytes())
        rest = rest >> CHUNK
        more = rest > 0
        if not more.any():
            return out
        bits = np.packbits(more, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(_POPCOUNT[bits], dtype=np.int64)])
        out += [bits.tobytes(), ones[:: STEP // 8].astype("<u4").tobytes()]
        rest = rest[more]


class Codes:
    """Random access to the ids of one file."""

    def __init__(self, levels: list[memoryview | bytes]) -> None:
        self.chunks = [np.frombuffer(x, np.uint8) for x in levels[::3]]
        self.bits = [np.frombuffer(x, np.uint8) for x in levels[1::3]]
        self.ranks = [np.frombuffer(x, "<u4") for x in levels[2::3]]

    def __len__(self) -> int:
        return len(self.chunks[0])

    def __getitem__(self, i: int) -> int:
        value = 0
        for level, chunks in enumerate(self.chunks):
            value |= int(chunks[i]) << (CHUNK * level)
            if level == len(self.bits) or not self.bits[level][i >> 3] >> (i & 7) & 1:
                return value
            block = i // STEP
            before = self.bits[level][block * STEP // 8 : i >> 3]
            part = int(self.bits[level][i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(self.ranks[level][block]) + int(_POPCOUNT[before].sum()) + int(_POPCOUNT[part])
        raise AssertionError("the last level has no continuation")

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        place = np.arange(len(self))
        out = np.zeros(len(self), np.uint32)
        for level, chunks in enumerate(self.chunks):
            out[place] |= chunks.astype(np.uint32) << np.uint32(CHUNK * level)
            if level < len(self.bits):
                place = place[np.unpackbits(self.bits[level], bitorder="little", count=len(chunks)).astype(bool)]
        return out


def pack(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, start: int) -> bytes:
    places = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    sections = [doc_ids.astype("<i8").tobytes(), places.tobytes(), struct.pack("<Q", start), *encode(ids)]
    return MAGIC + struct.pack("<I", len(sections)) + struct.pack(f"<{len(sections)}Q", *map(len, sections)) + b"".join(sections)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, int, Codes]:
    """Document ids, first places, start within the partition, codes."""
    if data[:4] != MAGIC:
        raise ValueError("not a code file")
    n = struct.unpack_from("<I", data, 4)[0]
    view, at, parts = memoryview(data), 8 + 8 * n, []
    for size in struct.unpack_from(f"<{n}Q", data, 8):
        parts.append(view[at : at + size])
        at += size
    return np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], "<u8"), struct.unpack("<Q", parts[2])[0], Codes(parts[3:])


# ---- tokenizing ---------------------------------------------------------------


def encoder(path: str) -> Encoder:
    """One per worker process, so that what it remembers serves all its tasks of a stage."""
    return kept(("byte level", path), lambda: Encoder(path))


# ---- files --------------------------------------------------------------------


def _write(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename: a repeated or lost task leaves whole files only."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder if re.match(r"\w+:/", folder) else f"file://{folder}")
    store.create_dir(path, recursive=True)
    trial = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(trial) as out:
        out.write(data)
    store.move(trial, f"{path}/{name}")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of all documents in ascending id order; returns (part, file, docs, tokens), one row per file.

    Documents are dealt by ranges of their id, so that each task encodes its range and writes files of ``file_tokens`` ids.
    Rows of one id are dealt on by the beginning and the hash of the text, and equal rows by their place in the input, so
    no id or text is one task; whole texts would be too long for the sample that finds the ranges.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = ["id", "head", "h", "at"]
    rows = docs.select(id_of(id_col).alias("id"), text.alias("text")).withColumn("head", F.left("text", F.lit(HEAD))).withColumn("h", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        names, lengths, held = [], [], []
        start = count = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal start, count, number
            name = f"part-{part:06d}-{number:06d}.dac"
            _write(folder, name, pack(np.concatenate(names), np.concatenate(lengths), np.concatenate(held), start))
            row = pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [sum(map(len, names))], "tokens": [count]}, pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))
            names.clear(), lengths.clear(), held.clear()
            start, count, number = start + count, 0, number + 1
            return row

        for whole in batches:
            for b in slices(whole):
                coded = coder(b.column(1).to_pylist())
                names.append(b.column(0).to_numpy())
                lengths.append(np.fromiter((len(x) + 1 for x in coded), np.int64, len(coded)))
                held.append(np.concatenate([y for x in coded for y in (x, np.array([end_id]))]).astype(np.uint32))
                count += len(held[-1])
                if count >= file_tokens:
                    yield flush()
        if names:
            yield flush()

    return stored(rows.mapInArrow(run, "part int, file string, docs long, tokens long"))


def read(index: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; only the token count of each partition reaches the driver."""
    spark = index.sparkSession
    per = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    first, total = {}, 0
    for part in sorted(per):
        first[part], total = total, total + per[part]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not per:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.dac").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                part = int(path.rsplit("/", 1)[1].split("-")[1])
                ids, places, start, codes = unpack(data.as_py())
                values = codes.all().astype("<u4")
                sums = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                at = places.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at[:-1] + start + first[part]), pa.array(np.diff(at)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, schema)


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None, **how: object) -> DataFrame:
    """Write ``docs`` and read the digest of every document back from the files."""
    folder = folder or shared_dir(docs.sparkSession)
    return read(write(docs, tokenizer, folder, end_id, **how), folder)
