"""Cross-tokenizer alignment: groups of tokens of two tokenizers between the byte offsets where both end a token.

Per text the cumulative ends of one side become an end-to-index dictionary, in which those of the other are looked up; the
sorted keys that both hold slice the two id lists into groups, and every slice links all its ids of one side with all of the other.  Two passes: the first
writes ids, slices and digests, and counts in how many documents each linked id pair stands; the second reads ids and
slices back and looks the counts up.  The table of pairs goes to all tasks if it was measured small, else the pairs of
each document are joined with it, salted, and added up again.

Defined results: texts that are null, empty or not spelled by the tokens of either side have no tokens - zeros and an
empty digest; rows with equal ids and repeated texts are documents of their own; null ids stay null; very long texts are
expanded in parts by ranges of the first side's ids; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import kept, prepare, shared_dir, slices
from corpuswash.llm.pieces import ByteLevel, SentencePiece, cut, gathered
from corpuswash.plans.scale import SALTS

#: Bytes of text aligned at a time, and links expanded at a time.
SLICE, LINKS = 1 << 20, 2_000_000
#: Pairs held before they are handed on, and pairs that are broadcast at most (12 bytes each).
HELD, BROADCAST_PAIRS = 1_500_000, 6_000_000
MEMORY = 72 << 20
#: Bits of an id in a pair.
BITS = 20
_LOW = (1 << BITS) - 1

Aligned = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Aligner:
    """Both tokenizers; ids of a text with its leading space, cut into groups."""

    def __init__(self, byte_level: str, piece_model: str) -> None:
        self.a, self.b = ByteLevel(byte_level, specials_are_text=True, most=MEMORY), SentencePiece(piece_model, most=MEMORY)
        self.spelled = (self.a.token_bytes(), self.b.token_bytes())
        if max(map(len, self.spelled)) > 1 << BITS:
            raise ValueError("a vocabulary has more ids than a pair can hold")
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in self.spelled)
        self.names = [f"{i}{s}" for i in range(max(map(len, self.spelled))) for s in ",|;"]

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of either side of ``texts``, each with its leading space."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        if self.b.cuts:
            plain, distinct, codes, bounds = cut(texts, self.b.ODD)
            if len(plain):
                (a, at_a), (b, at_b) = (gathered(*x.memory(distinct), codes, bounds) for x in (self.a, self.b))
                for k, i in enumerate(plain.tolist()):
                    out[i] = (a[at_a[k] : at_a[k + 1]], b[at_b[k] : at_b[k + 1]])
        rest = [i for i, x in enumerate(out) if x is None]
        own = [texts[i] for i in rest]
        for i, a, b in zip(rest, self.a.whole(own), self.b.whole(own), strict=True):
            out[i] = (a, b)
        return out  # type: ignore[return-value]

    def groups(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Sizes of the slices on either side; None if one side does not spell the text."""
        spelled_a, spelled_b = self.spelled
        whole = text.encode("utf-8", "surrogatepass")
        if b"".join(map(spelled_a.__getitem__, a.tolist())) != whole or b"".join(map(spelled_b.__getitem__, b.tolist())) != whole:
            return None
        ends_a, ends_b = np.cumsum(self.sizes[0][a]).tolist(), np.cumsum(self.sizes[1][b]).tolist()
        index_a = dict(zip(ends_a, range(1, len(a) + 1), strict=True))
        # the other side's ends rise, so the common keys are found in order; their place there is its own index
        at = np.fromiter(map(index_a.get, ends_b, repeat(0)), np.int64, len(b))
        index_b = np.flatnonzero(at) + 1
        return np.diff(at[index_b - 1], prepend=0), np.diff(index_b, prepend=0)

    def digest(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> str:
        """SHA-256 of the groups written as ``a1,a2|b1;a3|b2``."""
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.repeat(before_b, size_a)] = a.astype(np.int64) * 3
        code[np.arange(len(b)) + np.repeat(before_a + size_a, size_b)] = b.astype(np.int64) * 3
        code[before_b + before_a + size_a - 1] += 1
        code[before_b + before_a + size_a + size_b - 1] += 2
        names, h = self.names, sha256()
        for at in range(0, len(code), 1 << 18):
            part = "".join(map(names.__getitem__, code[at : at + (1 << 18)].tolist()))
            h.update((part[:-1] if at + (1 << 18) >= len(code) else part).encode())
        return h.hexdigest()


def aligner(byte_level: str, piece_model: str) -> Aligner:
    """One per worker process and stage."""
    return kept(("aligner", byte_level, piece_model), lambda: Aligner(byte_level, piece_model))


def expanded(docs: list[Aligned], most: int = LINKS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the document, pair, links) of all links, added up per document and pair.

    Documents are taken together up to ``most`` links.  One with more is expanded by ranges of its first side's ids, whose
    pairs cannot meet again in another range.
    """
    held: list[int] = []
    total = 0
    for i, (_, _, size_a, size_b) in enumerate(docs):
        n = int((size_a * size_b).sum())
        if held and total + n > most:
            yield _together(docs, held)
            held, total = [], 0
        if n > most:
            for pair, links in _by_ranges(docs[i], most):
                yield np.full(len(pair), i), pair, links
        elif n:
            held.append(i)
            total += n
    if held:
        yield _together(docs, held)


def _repeats(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ..."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _together(docs: list[Aligned], some: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b, size_a, size_b = (np.concatenate([docs[i][k] for i in some]).astype(np.int64) for k in range(4))
    owner = np.repeat(np.arange(len(some)), [len(docs[i][2]) for i in some])
    wide = np.repeat(size_b, size_a)
    first = np.repeat(np.cumsum(size_b) - size_b, size_a)
    pair = (np.repeat(a, wide) << BITS) | b[np.repeat(first, wide) + _repeats(wide)]
    key, links = np.unique((np.repeat(np.repeat(owner, size_a), wide) << (2 * BITS)) | pair, return_counts=True)
    return np.array(some)[key >> (2 * BITS)], key & ((1 << (2 * BITS)) - 1), links


def _by_ranges(doc: Aligned, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    a, b, size_a, size_b = doc
    group = np.arange(len(size_a))
    (key_a, times_a), (key_b, times_b) = (np.unique((np.repeat(group, size) << BITS) | ids.astype(np.int64), return_counts=True) for ids, size in ((a, size_a), (b, size_b)))
    at_b = np.searchsorted(key_b >> BITS, np.arange(len(group) + 1))
    order = np.argsort(key_a & _LOW, kind="stable")
    ids, groups, times = (key_a & _LOW)[order], (key_a >> BITS)[order], times_a[order]
    wide = at_b[groups + 1] - at_b[groups]
    last, at = np.cumsum(wide), 0
    while at < len(ids):
        to = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + most, "right")))
        while to < len(ids) and ids[to] == ids[to - 1]:  # all places of an id stay together
            to += 1
        n = wide[at:to]
        place = np.repeat(at_b[groups[at:to]], n) + _repeats(n)
        pair = (np.repeat(ids[at:to], n) << BITS) | (key_b[place] & _LOW)
        keys, where = np.unique(pair, return_inverse=True)
        links = np.zeros(len(keys), np.int64)
        np.add.at(links, where, np.repeat(times[at:to], n) * times_b[place])
        yield keys, links
        at = to


def _packed(x: np.ndarray) -> bytes:
    """Slice sizes: one byte each, or eight if one is larger."""
    return b"\1" + x.astype(np.uint8).tobytes() if not len(x) or x.max() < 256 else b"\0" + x.astype("<i8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[:1] == b"\1" else "<i8", offset=1).astype(np.int64)


_FIRST = "doc_id {}, ids_a binary, ids_b binary, sizes_a binary, sizes_b binary, n_links long, groups_sha256 string"


def _aligning(byte_level: str, piece_model: str) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(byte_level, piece_model)
        for whole in batches:
            for part in slices(whole, most=SLICE):
                texts = [f" {t}" if t else "" for t in part.column(1).to_pylist()]
                have = [i for i, t in enumerate(texts) if t]
                cells: list[tuple] = [(b"", b"", b"", b"", 0, "")] * len(texts)
                for i, (a, b) in zip(have, work.ids([texts[i] for i in have]), strict=True):
                    sizes = work.groups(texts[i], a, b)
                    if sizes is not None:
                        cells[i] = (a.astype("<u4").tobytes(), b.astype("<u4").tobytes(), *map(_packed, sizes), int((sizes[0] * sizes[1]).sum()), work.digest(a, b, *sizes))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x, k) for x, k in zip(zip(*cells, strict=True), (pa.binary(),) * 4 + (pa.int64(), pa.string()), strict=True)]], ["doc_id", "ids_a", "ids_b", "sizes_a", "sizes_b", "n_links", "groups_sha256"])

    return run


def _read(b: pa.RecordBatch) -> list[Aligned]:
    """Ids and slices of the rows of a stored batch; its first column is the row's own."""
    a, z, size_a, size_b = (b.column(k).to_pylist() for k in range(1, 5))
    return [(np.frombuffer(w, "<u4"), np.frombuffer(x, "<u4"), _unpacked(y), _unpacked(v)) if w else (np.zeros(0, np.int64),) * 4 for w, x, y, v in zip(a, z, size_a, size_b, strict=True)]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from slices(whole, most=4 * SLICE)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, docs): documents of the task that hold a pair, added up."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        pairs, docs = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, docs = pairs[order], docs[order]
        new = np.flatnonzero(np.diff(pairs, prepend=-1))
        return pairs[new], np.add.reduceat(docs, new)

    def flush() -> Iterator[pa.RecordBatch]:
        pairs, docs = merged()
        for at in range(0, len(pairs), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[at : at + (1 << 16)]), pa.array(docs[at : at + (1 << 16)])], ["pair", "docs"])

    for part in _few(batches):
        for _, pair, _ in expanded(_read(part)):
            pairs, docs = np.unique(pair, return_counts=True)
            held.append((pairs, docs.astype(np.int64)))
            size += len(pairs)
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from flush()
                    held, size = [], 0
    if held:
        yield from flush()


def _looking(sent: object) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, best = sent.value  # type: ignore[attr-defined]
        for part in _few(batches):
            aligned, n = _read(part), part.num_rows
            top, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for who, pair, links in expanded(aligned):
                count = docs[np.searchsorted(pairs, pair)].astype(np.int64)
                np.add.at(total, who, count * links)
                np.add.at(top, who, np.where(count == best[pair >> BITS], links, 0))
            sizes = [[len(x[k]) for x in aligned] for k in range(3)]
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(s, pa.int64()) for s in sizes], part.column(5), pa.array(top), pa.array(total), part.column(6)], _COLUMNS)

    return run


_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, pair, links) of the rows of (row, ids and slices)."""
    for part in _few(batches):
        rows = part.column(0).to_numpy()
        for who, pair, links in expanded(_read(part)):
            yield pa.RecordBatch.from_arrays([pa.array(rows[who]), pa.array(pair), pa.array(links.astype(np.int64))], ["row", "pair", "links"])


def align(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    ``n_best``: links whose pair stands in as many documents as any pair of its first id does; ``count_sum``: documents of
    the pair, added up over all links.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    folder = shared_dir(spark)
    rows.mapInArrow(_aligning(byte_level, piece_model), _FIRST.format(kind)).write.option("compression", "zstd").parquet(folder)
    kept = spark.read.parquet(folder)
    parts = ["ids_a", "ids_b", "sizes_a", "sizes_b"]
    table_at = shared_dir(spark)
    kept.where("n_links > 0").select("doc_id", *parts).mapInArrow(_counting, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")).write.parquet(table_at)
    table = spark.read.parquet(table_at)
    if table.count() <= broadcast_pairs:
        found = table.toArrow()
        pairs, counts = found["pair"].to_numpy(), found["docs"].to_numpy()
        order = np.argsort(pairs)
        pairs, counts = pairs[order], counts[order]
        best = np.zeros((int(pairs[-1]) >> BITS) + 1 if len(pairs) else 1, np.int64)
        np.maximum.at(best, pairs >> BITS, counts)
        if not len(counts) or counts.max() < 1 << 31:
            counts = counts.astype(np.int32)
        sent = spark.sparkContext.broadcast((pairs, counts, best))
        schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COLUMNS[1:-1]) + ", groups_sha256 string"
        return kept.select("doc_id", *parts, "n_links", "groups_sha256").mapInArrow(_looking(sent), schema)
    return _joined(kept, table)


def _joined(kept: DataFrame, table: DataFrame) -> DataFrame:
    """The same beyond the bound: pairs of every document joined with the table; a pair of many documents is salted."""
    spark = kept.sparkSession
    parts = ["ids_a", "ids_b", "sizes_a", "sizes_b"]
    numbered_at = shared_dir(spark)
    kept.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(numbered_at)
    rows = spark.read.parquet(numbered_at)
    first = F.shiftright("pair", BITS)
    best = table.groupBy(first.alias("a")).agg(F.max("docs").alias("best"))
    marked = table.withColumn("a", first).join(best, "a").select("pair", "docs", (F.col("docs") == F.col("best")).alias("top"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    links = rows.select("row", *parts).mapInArrow(_linking, "row long, pair long, links long").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    per = links.join(marked, ["pair", "salt"]).groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("docs") * F.col("links")).alias("count_sum"))
    bytes_of = lambda c: F.octet_length(c) - 1
    groups = F.when(F.octet_length("ids_a") == 0, 0).when(F.substring("sizes_a", 1, 1) == F.lit(b"\1"), bytes_of("sizes_a")).otherwise(bytes_of("sizes_a") / 8)
    own = rows.select("row", "doc_id", (F.octet_length("ids_a") / 4).cast("long").alias("n_a"), (F.octet_length("ids_b") / 4).cast("long").alias("n_b"), groups.cast("long").alias("n_groups"), "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return own.join(per, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
