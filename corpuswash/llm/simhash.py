"""SimHash near-dedup: fingerprints split into blocks, joined on blocks, verified.

Two jobs share the fingerprinting:

* ``fingerprints`` + ``links`` + ``classes``: 64-bit SimHash, links at a Hamming distance of at most ``max_distance``.
* ``near_duplicates``: five-word shingles, Jaccard similarity of 0.8 or more.  The fingerprints are split into blocks,
  joined on blocks and verified by distance as above; what is linked is compared exactly.  Pairs that differ in more bits
  (about ten at 0.8) leave no useful block of *bits*, so for them the pigeonhole argument is applied to the shingles that
  the fingerprint is made of: in any common order two similar sets share one of their first n - ceil(0.8 n) + 1 shingles.
  Rare ones come first, so blocks are small; candidates are verified by SimHash distance and exactly.  No pair is lost
  (but for a SimHash distance five deviations beyond that of a pair at 0.8).

Defined results: a null text is an empty one; no words give the fingerprint 0 and form one class; repeated rows and equal
texts fall into one class; null ids count as one id; extra columns are kept or ignored, never read; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import components, give_back, id_of, numbered, prepare, sized, slices, stored
from corpuswash.llm.phrases import _BYTE_BASE, _LOWER, _WORD_BASE, WINDOW, Bitmap, _ranges, _salt, bitmap
from corpuswash.plans.scale import lookup_join

SEED = 42
HOT = 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
SHINGLE, SIMILARITY = 5, 0.8
#: Bytes of text hashed at a time, shingles of a task counted together, and counts that set frequent ones apart.
SLICE, PART, LEVELS = 1 << 20, 600_000, (8, 64, 512, 4096)
#: Blocks of up to so many texts are compared in full; larger ones with a leader, then with ``TURNS`` more, then the rest,
#: where a task joins about ``CHUNK`` members with those outside the largest class.
FULL_BLOCK, TURNS, CHUNK = 24, 2, 256
#: A pair at 0.8 or more differs in 10 of 64 bits, with a deviation of 3; five deviations more are let through.
FAR_BITS = 25
#: Classes of hashes, in bits, whose parities say how much two sets must differ at least.
MARK_BITS = 9


def shingle_digests(text: str | None, k: int, seed: int = SEED) -> bytes:
    """The 8-byte XXH64 digests of all k-word shingles, repeats included, in order (A-Z lower-cased)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return b""
    digest, line = xxhash.xxh64_digest, b" ".join(words)
    if len(words) <= k:
        return digest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - k + 1]
    return b"".join([digest(line[a:b], seed) for a, b in zip(starts.tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)])


def simhash(digests: bytes) -> bytes:
    """Bit set where it is set in over half the digests; eight zero bytes without digests."""
    n, ones = len(digests) // 8, np.zeros(64, np.int64)
    rows = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the SimHash of every whole text as a signed 64-bit number."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                fps = b"".join(simhash(shingle_digests(t, shingle)) for t in b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(fps, ">i8").astype(np.int64))], ["id", "fp"])

    return docs.select(id_of(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


def _masks(max_distance: int) -> list[int]:
    """Pairs of blocks out of ``max_distance + 2``: at most ``max_distance`` blocks differ, so one pair is equal in both."""
    n = max_distance + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_distance: int = 2, hot: int = HOT) -> DataFrame:
    """(a, b): links between distinct fingerprints at ``max_distance`` or less, enough to span every class.

    Blocks with up to ``hot`` fingerprints are joined and verified.  In a larger block every fingerprint is listed under
    itself and its one-bit changes outside the block: two that differ in two bits or fewer meet under one of these, and
    all that meet there differ in at most two bits, so they are linked to the smallest of them - linear, and exact.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance: 0, 1 or 2")
    spark, none = fps.sparkSession, "a long, b long"
    if max_distance == 0:
        return spark.createDataFrame([], none)
    masks = _masks(max_distance)
    one = fps.select("fp").distinct()
    keyed = one.select("fp", F.inline(F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])))
    sizes = keyed.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(keyed.join(sizes, ["block", "key"]))
    few = met.where(F.col("n") <= hot)
    pairs = few.select("block", "key", F.col("fp").alias("a")).join(few.select("block", "key", F.col("fp").alias("b")), ["block", "key"])
    near = pairs.where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)).select("a", "b")
    flips = F.create_map(*[x for i, m in enumerate(masks) for x in (F.lit(i), F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)) for k in range(64) if not m >> k & 1]))])
    flipped = met.where(F.col("n") > hot).select("block", "fp", F.explode(flips[F.col("block")]).alias("flip"))
    under = flipped.select("block", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    if max_distance == 2:
        low = under.groupBy("block", "at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
        far = under.join(low, ["block", "at"]).where("fp <> b").select(F.col("fp").alias("a"), "b")
    else:
        far = under.join(one.select(F.col("fp").alias("at")), "at").where("fp > at").select(F.col("fp").alias("a"), F.col("at").alias("b"))
    return near.unionByName(far).distinct()


def classes(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): every row with the smallest id that its fingerprint reaches."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col))
    low = fps.groupBy("fp").agg(F.min("id").alias("id"))
    roots = components(links(low, max_distance))
    hung = stored(low.join(roots, low["fp"] == roots["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root")))
    least = hung.groupBy("root").agg(F.min("id").alias("component_id"))
    return fps.join(hung.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


# ---- Jaccard 0.8 on five-word shingles ------------------------------------


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The distinct hashes of all k-word shingles of each text (A-Z lower-cased; fewer words: the whole sequence).

    All texts of a batch are hashed together by prefix polynomials, first the words, then the shingles.
    """
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    code = np.frombuffer(b"\n".join([*coded, b""]), np.uint8)
    starts, ends, values, at = [], [], [], 0
    while at < len(code):
        to = min(at + WINDOW, len(code))
        while to < len(code) and not _BLANK[code[to - 1]]:  # a window ends behind a word
            more = np.flatnonzero(_BLANK[code[to : to + WINDOW]])
            to = to + int(more[0]) + 1 if len(more) else min(to + WINDOW, len(code))
        own = _LOWER[code[at:to]]
        edge = np.flatnonzero(np.diff((~_BLANK[own]).view(np.int8), prepend=0, append=0))
        s, e = edge[::2], edge[1::2]
        values.append(_ranges(own.astype(np.uint64) + np.uint64(1), _BYTE_BASE, s, e))
        starts.append(s + at), ends.append(e + at)
        at = to
    if not starts:
        return [np.zeros(0, np.uint64)] * len(texts)
    word = np.concatenate(values)
    first = np.searchsorted(np.concatenate(starts), bounds)
    count = np.diff(first)
    places = np.maximum(count - k + 1, np.minimum(count, 1))
    begin = np.repeat(first[:-1], places) + np.arange(int(places.sum())) - np.repeat(np.cumsum(places) - places, places)
    h = _ranges(word, _WORD_BASE + 2 * k, begin, begin + np.repeat(np.minimum(count, k), places))
    cuts = np.concatenate([[0], np.cumsum(places)]).tolist()
    return [np.unique(h[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def _signature(h: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(h.tobytes(), 1) - (1 << 63) if len(h) else 0


def _repeated(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(h, c): shingles that stand in several different sets of a part of the task, with their number there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            keep = c > 1
            return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(c[keep].astype(np.int64))], ["h", "c"])

        for whole in batches:
            for b in slices(whole, most=SLICE):
                for h in shingle_sets(b.column(1).to_pylist(), shingle):
                    if (sign := _signature(h)) not in seen:
                        seen.add(sign)
                        held.append(h)
                        size += len(h)
                if size > PART:
                    yield flush()
                    held, seen, size = [], set(), 0
        if held:
            yield flush()

    return run


def frequent(source: DataFrame, shingle: int, levels: tuple[int, ...] = LEVELS) -> list[Bitmap]:
    """For each level a bitmap of the shingles that may be as frequent.

    Any order of the shingles that is the same for all texts gives right results, so estimates do: the counts of parts are
    added up where a part has the shingle twice.
    """
    found = stored(source.mapInArrow(_repeated(shingle), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= levels[0]))
    return [bitmap(found.where(F.col("c") >= x).select(F.lit("").alias("lang"), F.col("h").alias("fp"))) for x in levels]


def marks(h: np.ndarray) -> list[int]:
    """For each class of hashes (by their first ``MARK_BITS`` bits) whether their number is odd, packed into longs.

    Every bit in which two sets differ stands for a hash that only one of them has, so the bits bound their difference from
    below.
    """
    odd = np.bincount((h >> np.uint64(64 - MARK_BITS)).astype(np.int64), minlength=1 << MARK_BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).tolist()


def _features(shingle: int, similarity: float, maps: list[Bitmap]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, h, same, n, fp, keys, marks): signature, size and SimHash of the shingle set, its rarest shingles in order, and
    its marks.

    Two sets at the similarity share one of their n - ceil(similarity * n) + 1 first shingles in any common order.
    """
    salt = _salt("")

    def keys(h: np.ndarray) -> list[int]:
        level = np.zeros(len(h), np.int8)
        for m in maps:
            level += m.has(h, salt)
        order = np.lexsort((h * np.uint64(0x9E3779B97F4A7C15), level))
        return h[order[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]].view(np.int64).tolist() if len(h) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, most=SLICE):
                sets = shingle_sets(b.column(1).to_pylist(), shingle)
                fps = [int(np.frombuffer(simhash(h.tobytes()), ">i8")[0]) if len(h) else 0 for h in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array([_signature(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()), pa.array(fps, pa.int64()), pa.array([keys(h) for h in sets], pa.list_(pa.int64())), pa.array([marks(h) for h in sets], pa.list_(pa.int64()))],
                    ["id", "h", "same", "n", "fp", "keys", "marks"],
                )

    return run


def _sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, most=SLICE):
                sets = [h.tobytes() for h in shingle_sets(b.column(1).to_pylist(), shingle)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["same", "hashes"])

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, both, n_a, n_b): hashes that the two sets of a row share, and the sizes of the sets."""
    for b in batches:
        give_back()
        both = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
        sizes = [pa.array(pc.binary_length(b.column(k)).to_numpy().astype(np.int64) // 8) for k in (2, 3)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()), *sizes], ["a", "b", "both", "n_a", "n_b"])


def _shared(sent: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, same, n, fp, pos) of (same, n, fp, keys), for the keys that several nodes may have."""
    salt = _salt("")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value  # type: ignore[attr-defined]
        for b in batches:
            give_back()
            lists = b.column(3)
            key = lists.flatten().to_numpy()
            size = np.diff(lists.offsets.to_numpy())
            node = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
            keep = np.flatnonzero(known.has(key.view(np.uint64), salt))
            taken = [b.column(k).take(pa.array(node[keep])) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), *taken, pa.array(pos[keep].astype(np.int32))], ["key", "same", "n", "fp", "pos"])

    return run


class _Search:
    """The candidates of blocks of bits and of blocks of shingles, and what has been compared so far."""

    def __init__(self, nodes: DataFrame, source: DataFrame, shingle: int, similarity: float) -> None:
        self.least = similarity
        self.far = FAR_BITS + 64 * math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi - 64 * math.acos(1.6 / 1.8) / math.pi
        self.spark = spark = nodes.sparkSession
        many = stored(nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
        full = stored(many.where(F.col("c") > FULL_BLOCK))
        # only keys of several nodes are listed; the few others that the bitmap lets through meet nobody
        sent = spark.sparkContext.broadcast(bitmap(many.select(F.lit("").alias("lang"), F.col("key").alias("fp"))))
        listed = nodes.select("same", "n", "fp", "keys").mapInArrow(_shared(sent), "key long, same long, n long, fp long, pos int")
        self.block = stored(listed)
        self.full = stored(lookup_join(self.block, full, ["key"], "inner", ["same"]).select("key", "c", "same", "n", "fp", "pos"))
        self.linked = stored(self._linked(nodes))
        self.marks = stored(nodes.select("same", "n", "marks"))
        self.pairs = stored(self.hopeful(self._few(full)).unionByName(self.linked.select("same", "same_b")).distinct())
        wanted = self.pairs.select(F.explode(F.array("same", "same_b")).alias("same")).unionByName(self.full.select("same")).distinct()
        slim = stored(nodes.join(wanted, "same").select("same", "first.id", "first.h"))
        picked = source.join(sized(slim), ["id", "h"]).select("same", "text").dropDuplicates(["same"])
        self.sets = stored(picked.mapInArrow(_sets(shingle), "same long, hashes binary"))
        self.done: DataFrame | None = None
        self.roots = spark.createDataFrame([], "node long, root long")

    def _linked(self, nodes: DataFrame) -> DataFrame:
        """(same, same_b, nearest): sets whose fingerprints are linked by blocks of bits.  One set stands for each
        fingerprint and is paired with the others that have it; ``nearest`` marks one pair of every set."""
        of = stored(nodes.select("same", "fp"))
        low = stored(of.groupBy("fp").agg(F.min("same").alias("same_b")))
        equal = of.join(low, "fp").where("same <> same_b").select("same", "same_b", F.lit(True).alias("nearest"))
        near = stored(links(low))
        first = near.groupBy("a").agg(F.min("b").alias("first"))
        ends = near.join(first, "a").join(low.select(F.col("fp").alias("a"), F.col("same_b").alias("same")), "a").join(low.withColumnRenamed("fp", "b"), "b")
        return equal.unionByName(ends.select("same", "same_b", (F.col("b") == F.col("first")).alias("nearest")))

    def _few(self, full: DataFrame) -> DataFrame:
        """All pairs of the blocks of up to ``FULL_BLOCK`` members that can be near."""
        rows = self.block.join(sized(full.select("key")), "key", "left_anti")
        few = numbered(rows, ["key"], [F.col("same")], "place")
        other = few.select("key", *[F.col(x).alias(f"{x}_b") for x in ("same", "n", "fp", "pos", "place")])
        return few.join(other, "key").where((F.col("place") > F.col("place_b")) & self.close()).select("same", "same_b").distinct()

    def rooted(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.roots.withColumnRenamed("node", "same"), "same", "left").withColumn("root", F.coalesce("root", "same"))

    def search(self) -> None:
        """Compare what the blocks of bits link, first one pair of every set, then all that is still apart: links and pairs
        of the blocks of shingles."""
        nearest = self.linked.where("nearest")
        if not nearest.isEmpty():
            self.compare(nearest)
        other = self.roots.select(F.col("node").alias("same_b"), F.col("root").alias("root_b"))
        apart = self.rooted(self.pairs).join(other, "same_b", "left").where(F.col("root") != F.coalesce("root_b", "same_b"))
        self.compare(apart)
        self.crowded()

    def close(self) -> Column:
        """Whether two members of a block can reach the similarity, by size, by what follows the shared shingle in the
        common order, and by SimHash distance."""
        t = self.least
        size = F.least("n", "n_b") >= t * F.greatest("n", "n_b")
        rest = F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b")) >= t / (1 + t) * (F.col("n") + F.col("n_b")) - 1e-6
        return size & rest & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_b"))) <= self.far)

    def hopeful(self, pairs: DataFrame) -> DataFrame:
        """The pairs (same, same_b) whose marks allow the similarity: sets of n and m hashes that reach t differ in
        (1 - t) / (1 + t) * (n + m) hashes at most.  Marks are small, so few pairs are left that need whole sets."""
        other = self.marks.select(*[F.col(x).alias(f"{x}_b") for x in ("same", "n", "marks")])
        both = pairs.select("same", "same_b").distinct().join(self.marks, "same").join(other, "same_b")
        differ = sum((F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("marks_b")[i])) for i in range((1 << MARK_BITS) // 64)), F.lit(0))
        return both.where(differ <= (1 - self.least) / (1 + self.least) * (F.col("n") + F.col("n_b")) + 1e-6).select("same", "same_b")

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Compare new pairs (same, same_b) exactly; keeps the links and returns (a, b, gap), a Jaccard distance."""
        pair = pairs.select(F.greatest("same", "same_b").alias("a"), F.least("same", "same_b").alias("b")).distinct()
        if self.done is not None:
            pair = pair.join(self.done.select("a", "b"), ["a", "b"], "left_anti")
        pair = stored(pair)
        # only the sets of these pairs are shuffled, once for both sides; they hold the sizes too
        wanted = stored(pair.select(F.explode(F.array("a", "b")).alias("same")).distinct())
        if wanted.isEmpty():
            got = self.spark.createDataFrame([], "a long, b long, gap double, near boolean")
            self.done = got if self.done is None else self.done
            return got
        sets = self.sets.join(sized(wanted), "same")
        side = lambda k, h: sets.select(F.col("same").alias(k), F.col("hashes").alias(h))
        two = pair.join(side("a", "x"), "a").join(side("b", "y"), "b")
        got = two.select("a", "b", "x", "y").mapInArrow(_compared, "a long, b long, both long, n_a long, n_b long")
        gap = 1 - F.col("both") / F.greatest(F.col("n_a") + F.col("n_b") - F.col("both"), F.lit(1))
        got = stored(got.select("a", "b", gap.alias("gap"), (F.col("both") >= self.least * (F.col("n_a") + F.col("n_b") - F.col("both")) - 1e-9).alias("near")))
        self.done = got if self.done is None else self.done.unionByName(got)
        if not got.where("near").isEmpty():  # without a new link the classes stay
            self.roots = components(self.done.where("near").select("a", "b"))
        return got

    def crowded(self) -> None:
        """Larger blocks: members are compared with leaders first, which joins a family of copies; then every two members
        that are still apart, unless their distances to the block's first leader differ too much for a link (Jaccard
        distances obey the triangle inequality)."""
        block = self.full
        if block.isEmpty():
            return
        least = F.min(F.struct("pos", "same", "n", "fp"))
        leaders = stored(block.groupBy("key").agg(least.alias("l")).select("key", F.col("l.same").alias("same_b")))
        self.compare(lookup_join(block, leaders, ["key"], "inner", ["same"]).where("same <> same_b"))
        gaps = lookup_join(block, leaders, ["key"], "inner", ["same"])
        known = self.done.select("a", "b", "gap")
        gaps = gaps.withColumn("a", F.greatest("same", "same_b")).withColumn("b", F.least("same", "same_b")).join(known, ["a", "b"], "left")
        block = stored(gaps.select(*block.columns, F.when(F.col("same") == F.col("same_b"), 0.0).otherwise(F.col("gap")).alias("gap")))
        names = ("same", "n", "fp", "pos", "root", "gap")
        for _ in range(TURNS):
            apart = self._apart(block)
            if apart.isEmpty():
                return
            lead = apart.where("out").groupBy("key").agg(F.min(F.struct("pos", *[x for x in names if x != "pos"])).alias("l"))
            lead = stored(lead.select("key", *[F.col(f"l.{x}").alias(f"{x}_b") for x in names]))
            self.compare(lookup_join(apart, lead, ["key"], "inner", ["same"]).where((F.col("root") != F.col("root_b")) & self.close() & self._gap()))
        apart = self._apart(block)
        if apart.isEmpty():
            return
        # members outside the largest class of a block meet all its members, dealt so that a task joins about CHUNK of these
        salts = F.ceil(F.col("c") / CHUNK)
        members = apart.withColumn("salt", F.pmod(F.xxhash64("same"), salts))
        outside = apart.where("out").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        outside = outside.select("key", "salt", *[F.col(x).alias(f"{x}_b") for x in (*names, "out")])
        once = ~F.col("out") | (F.col("same") > F.col("same_b"))
        self.compare(self.hopeful(members.join(outside, ["key", "salt"]).where((F.col("root") != F.col("root_b")) & once & self.close() & self._gap())))

    def _gap(self) -> Column:
        return F.coalesce(F.abs(F.col("gap") - F.col("gap_b")) <= 1 - self.least + 1e-9, F.lit(True))

    def _apart(self, block: DataFrame) -> DataFrame:
        """Members of the blocks with more than one class; ``out`` marks those outside the block's largest class."""
        rows = self.rooted(block)
        classes = rows.groupBy("key", "root").agg(F.count("*").alias("k"))
        largest = classes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("classes"))
        split = stored(largest.where("classes > 1").select("key", "main"))
        return stored(lookup_join(rows, split, ["key"], "inner", ["same"]).withColumn("out", F.col("root") != F.col("main")).drop("main"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, group, keep): class of every row and whether it is the one that stays (smallest id, then smallest h).

    ``h`` is the hash of the text; rows equal in id and text share one result row.  Equal shingle sets are one node, so
    thousands of copies cost one row.  Nodes are linked by their fingerprints, split into blocks, joined on blocks and
    verified, and compared exactly.  For pairs of more different bits a node is listed under its rarest shingles, by the
    pigeonhole argument all that a similar set must share one of; pairs that meet there are compared by size, place and
    SimHash distance first, then exactly.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(id_of(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    sent = docs.sparkSession.sparkContext.broadcast(frequent(source, shingle))
    rows = source.mapInArrow(lambda b: _features(shingle, similarity, sent.value)(b), "id long, h long, same long, n long, fp long, keys array<long>, marks array<long>")
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()))
    # one row stands for each set; the lists of keys are not shuffled to find it
    first = stored(rows.groupBy("same").agg(F.min(F.struct("id", "h", "at")).alias("first")).select(F.col("first.at").alias("at"), F.struct("first.id", "first.h").alias("first")))
    nodes = rows.join(sized(first), "at").select("same", "first", "n", "fp", "keys", "marks")
    search = _Search(nodes, source, shingle, similarity)
    search.search()
    low = stored(nodes.select("same", "first").join(search.roots.withColumnRenamed("node", "same"), "same", "left").select("same", "first", F.coalesce("root", "same").alias("root")))
    least = low.groupBy("root").agg(F.min("first").alias("group"))
    chosen = low.join(least, "root").select("same", "group")
    own = rows.select("id", "h", "same").distinct().join(chosen, "same")
    return own.select("id", "h", F.col("group.id").alias("group"), (F.struct("id", "h") == F.col("group")).alias("keep"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: object) -> DataFrame:
    """``docs`` with one row of each near-duplicate class; whole repeats of the row that stays are dropped too."""
    names = docs.columns
    marks = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    drop = stored(marks.where("not keep").select(F.col("id").alias("__id"), F.col("h").alias("__h")))
    key = docs.withColumn("__id", id_of(id_col)).withColumn("__h", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    again = stored(key.groupBy("__id", "__h").agg(F.count("*").alias("c")).where("c > 1").drop("c"))
    stay = key.join(sized(drop), ["__id", "__h"], "left_anti")
    if again.isEmpty():
        return stay.select(*names)
    single = stay.join(sized(again), ["__id", "__h"], "left_anti")
    return single.unionByName(stay.join(sized(again), ["__id", "__h"], "left_semi").dropDuplicates(["__id", "__h"])).select(*names)
