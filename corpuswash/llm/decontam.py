"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items in whole texts.

Texts become ``" w1 w2 ... "`` (A-Z lower-cased, words of letters, digits and all non-ASCII characters), so a pattern with a
space on both sides matches whole words only.  Patterns are searched by length class.  A table tells for every hashed
block how far the search may jump; where it says zero, the suffix and prefix of the position select the test strings, and
a comparison of the bytes decides.  Many stretches of text jump at once in numpy.

Defined results: null texts have no words and no hits; items without words have no window; windows of equal text count
for all their items; an item id in several rows is one item, items with a null id mark words but are not counted;
repeated documents are judged one by one; empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import id_of, prepare, slices, stored

WINDOW = 10
#: Benchmark text held by a task at once; a larger benchmark is searched in several passes.
BLOCK_BYTES = 8 << 20
STRETCH = 2048
CLASS_STARTS = (0, 8, 16, 32)

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def windows(items: list[tuple[object, str | None]], size: int = WINDOW) -> dict[bytes, set[str]]:
    """Window text with its border spaces -> ids of the items it belongs to."""
    found: dict[bytes, set[str]] = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found[b" " + b" ".join(w[i : i + size]) + b" "].update(() if item is None else (str(item),))
    return found


class _Class:
    """Shift table and suffix buckets for patterns of at least ``m`` bytes, looked at in their first ``m``."""

    def __init__(self, patterns: list[bytes]) -> None:
        self.m = m = min(map(len, patterns))
        self.b = b = min(8, m)
        self.mask = np.uint64((1 << (8 * b)) - 1)
        self.bits = np.uint64(64 - 20)
        self.shift = np.full(1 << 20, m - b + 1, np.int64)
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        pad = np.zeros((len(patterns), m + 8), np.uint8)
        pad[:, :m] = heads
        for j in range(m - b + 1):
            block = np.ascontiguousarray(pad[:, j : j + 8]).view("<u8")[:, 0] & self.mask
            np.minimum.at(self.shift, self._slot(block), m - b - j)
        suffix = np.ascontiguousarray(pad[:, m - b : m - b + 8]).view("<u8")[:, 0] & self.mask
        prefix = np.ascontiguousarray(pad[:, :8]).view("<u8")[:, 0] & self.mask
        keys = self._both(suffix, prefix)
        self.keys = np.unique(keys)
        self.buckets: dict[int, list[bytes]] = defaultdict(list)
        for k, p in zip(keys.tolist(), patterns, strict=True):
            self.buckets[k].append(p)

    def _slot(self, block: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((block ^ (block >> np.uint64(31))) * _MIX) >> self.bits

    @staticmethod
    def _both(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (suffix * _MIX) ^ (prefix + (prefix << np.uint64(7)))

    def search(self, text: bytes, eights: np.ndarray, end: int) -> Iterator[tuple[int, bytes]]:
        """All (start, pattern) in ``text[:end]``; ``eights`` holds the eight bytes that begin at each place."""
        last = end - self.m
        if last < 0:
            return
        at = np.arange(0, last + 1, STRETCH)
        stop = np.minimum(at + STRETCH, last + 1)
        reach = self.m - self.b
        while len(at):
            block = eights[at + reach] & self.mask
            jump = self.shift[self._slot(block)]
            here = np.flatnonzero(jump == 0)
            if len(here):
                start = at[here]
                key = self._both(block[here], eights[start] & self.mask)
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[place] == key
                for s, k in zip(start[hit].tolist(), key[hit].tolist(), strict=True):
                    for p in self.buckets[k]:
                        if text.startswith(p, s):
                            yield s, p
            at = at + np.maximum(jump, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]


class Searcher:
    def __init__(self, patterns: dict[bytes, set[str]]) -> None:
        self.items = patterns
        self.length = {p: p.count(b" ") - 1 for p in patterns}
        groups: dict[int, list[bytes]] = defaultdict(list)
        for p in patterns:
            groups[max(s for s in CLASS_STARTS if s <= len(p))].append(p)
        self.classes = [_Class(ps) for ps in groups.values()]

    def judge(self, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: number of words, hit word ranges (sorted, disjoint), ids of the items that occur."""
        split = [words_of(t) for t in texts]
        lines = [b" " + b" ".join(w) + b" " for w in split]
        text = b"".join(lines)
        eights = np.ndarray((len(text),), "<u8", text + bytes(8), strides=(1,))
        begins = np.cumsum([0, *map(len, lines)])
        found: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        hits = [h for c in self.classes for h in c.search(text, eights, len(text))]
        if hits:
            docs = np.searchsorted(begins, np.array([h[0] for h in hits]), side="right") - 1
            for d, h in zip(docs.tolist(), hits, strict=True):
                found[d].append(h)
        for d, w in enumerate(split):
            ranges: list[tuple[int, int]] = []
            items: set[str] = set()
            seen, word = int(begins[d]), 0
            for s, p in sorted(found.get(d, ())):
                word += text.count(b" ", seen, s)
                seen, end = s, word + self.length[p]
                items |= self.items[p]
                if ranges and word <= ranges[-1][1]:
                    ranges[-1] = (ranges[-1][0], max(end, ranges[-1][1]))
                else:
                    ranges.append((word, end))
            yield len(w), ranges, items


def _pieces(text: str | None, size: int, most: int) -> Iterator[bytes]:
    """Runs of words of about ``most`` bytes that overlap, so that every window of ``size`` words lies whole in one."""
    w, s = words_of(text), 0
    last = max(1, len(w) - size + 1) if w else 0
    while s < last:
        e = total = 0
        while s + e < last and (not e or total + len(w[s + e]) < most):
            total += len(w[s + e]) + 1
            e += 1
        yield b" ".join(w[s : s + e + size - 1])
        s += e


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int, size: int = WINDOW) -> tuple[int, Iterator[list]]:
    """Number of parts and the benchmark in parts of about ``most`` bytes, one after the other; long items are split."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    if total <= most:
        return 1, iter([[(r["i"], r["t"]) for r in rows.collect()]])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for p in _pieces(t, size, most // 8):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.string()), pa.array([p.decode("utf-8", "surrogatepass")], pa.string())], ["i", "t"])

    pieces = stored(rows.mapInArrow(split, "i string, t string"))
    parts = max(1, -(-pieces.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0] // most))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(parts))
    return parts, ([(r["i"], r["t"]) for r in pieces.where(part == k).collect()] for k in range(parts))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, ranges, items): one row per document row, in one pass per block of the benchmark."""
    spark = docs.sparkSession
    prepare(spark)
    out = "id long, row long, n_words long, ranges array<struct<a:long,b:long>>, items array<string>"
    source = docs.select(id_of(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    n, parts = _blocks(benchmark, item_col, item_text, block_bytes, window)
    if n > 1:
        source = stored(source.withColumn("row", F.monotonically_increasing_id()))
    else:
        source = source.withColumn("row", F.lit(0).cast("long"))

    def scan(sent: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(windows(sent.value, window))
            for whole in batches:
                for b in slices(whole):
                    rows = list(searcher.judge(b.column(1).to_pylist()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0),
                            b.column(2),
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([[{"a": x, "b": y} for x, y in r[1]] for r in rows], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                            pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string())),
                        ],
                        ["id", "row", "n_words", "ranges", "items"],
                    )

        return source.mapInArrow(run, out)

    if n == 1:
        return scan(spark.sparkContext.broadcast(next(parts))).drop("row")
    each = None
    for items in parts:
        sent = spark.sparkContext.broadcast(items)
        own = stored(scan(sent))  # one part at a time stands in the driver and the tasks
        sent.destroy()
        each = own if each is None else each.unionByName(own)
    found = each.groupBy("row", "id", "n_words").agg(F.flatten(F.collect_list("ranges")).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    step = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= x["a"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], x["b"]).alias("b")))),
    ).otherwise(F.concat(acc, F.array(x)))
    merged = F.aggregate(F.array_sort("r"), F.slice(F.col("r"), 1, 0), step)
    return found.select("id", "n_words", merged.alias("ranges"), "items")


def report(docs: DataFrame, benchmark: DataFrame, **how: object) -> DataFrame:
    """The contract's digest of ``hits``."""
    h = hits(docs, benchmark, **how)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return h.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    return sha256(",".join(sorted(items)).encode()).hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs; all columns stay."""
    spark = docs.sparkSession
    prepare(spark)
    out = docs
    n, parts = _blocks(benchmark, "item_id", "text", block_bytes, window)
    for items in parts:
        sent = spark.sparkContext.broadcast(items)
        at = out.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, at=at) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(windows(sent.value, window))
            for whole in batches:
                for b in slices(whole, at):
                    yield b.filter(pa.array([not r[1] for r in searcher.judge(b.column(at).to_pylist())], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
        if n > 1:
            out = stored(out)
            sent.destroy()
    return out
