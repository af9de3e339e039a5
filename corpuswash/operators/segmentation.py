"""Words of texts that are written without blanks: the most probable path through the lattice of dictionary words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswash.functions import patterns as P
from corpuswash.functions import places
from corpuswash.functions import text as T
from corpuswash.operators.lexicon import Lexicon
from corpuswash.plans import workers
from corpuswash.plans.scale import by_frequency, stored

#: Costs are -1000 times the natural logarithm of a probability, rounded.
SCALE = 1000
#: A character that is no word costs as if it had been counted once in a text this many times as long.
UNSEEN = 10
#: Characters whose lattice is held at a time.
PART = 1 << 18
#: Characters of a block of texts, which sends each seldom word of a long dictionary once.
BLOCK = 1 << 20
_CJK = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), P.CJK_CLASS) + "]+")
_ALL = re.compile(r"\S+")


@dataclass(frozen=True)
class Dictionary:
    """Words with their costs: ``(word, cost, n)`` beside the measured list, and the cost of an unknown character."""

    lexicon: Lexicon
    costs: DataFrame
    unknown: int

    @staticmethod
    def of(words: DataFrame, word: str = "word", count: str = "count") -> Dictionary:
        """From counted words; a word listed more than once is added up, words that hold blanks or count nothing go."""
        w = T.strip(F.col(word))
        own = words.select(w.alias("word"), F.col(count).cast("long").alias("n")).where((F.col("n") > 0) & (F.col("word") != "") & ~F.rlike("word", F.lit(f"[{P.WS}]")))
        counted = stored(own.groupBy("word").agg(F.sum("n").alias("n")))
        total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
        cost = lambda n, of: F.round(F.log(F.lit(float(max(of, 1))) / n) * SCALE).cast("long")
        costs = stored(counted.select("word", cost(F.col("n"), total).alias("cost"), "n"))
        unknown = words.sparkSession.range(1).select(cost(F.lit(1.0), UNSEEN * total).alias("c")).first()["c"]
        return Dictionary(Lexicon.of(costs, ord=None), costs, unknown)


@dataclass(frozen=True)
class Lattice:
    """The words of a dictionary as arrays: sorted hashes with costs and characters, and filters of the words and their beginnings."""

    seed: int
    longest: int
    bits: int
    begun: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    costs: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    points: np.ndarray

    @staticmethod
    def _grow(points: np.ndarray, at: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        h = (h ^ points[at + n - 1]) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def _bit(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def of(words: list[str], costs: np.ndarray) -> Lattice:
        points, starts = places.codes(words)
        first, sizes = starts[:-1], np.diff(starts) - 1
        longest, bits = int(sizes.max(initial=0)), max(10, (32 * len(words) + 1).bit_length())
        for seed in range(1, 100):
            begun, known = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
            own = Lattice(seed, longest, bits, begun, known, *[np.zeros(0)] * 3, first, points)
            ids, at, h, hashes = np.arange(len(words)), first, np.full(len(words), seed, np.uint64), np.zeros(len(words), np.uint64)
            for n in range(1, longest + 1):
                h = Lattice._grow(points, at, h, n)
                last = sizes[ids] == n
                hashes[ids[last]] = h[last]
                known[own._bit(h[last])] = True
                ids, at, h = ids[~last], at[~last], h[~last]
                begun[own._bit(h)] = True
            order = np.argsort(hashes)
            if not (np.diff(hashes[order].view(np.int64)) == 0).any():
                return Lattice(seed, longest, bits, begun, known, hashes[order], costs[order], sizes[order], first[order], points)
        raise RuntimeError("words of equal hash under every seed")

    def hits(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, length, cost) of all words in each text, in order."""
        points, starts = places.codes(texts)
        at, found = np.arange(len(points)), []
        h = np.full(len(at), self.seed, np.uint64)
        for n in range(1, self.longest + 1):
            inside = at + n <= len(points)
            at, h = at[inside], h[inside]
            h = self._grow(points, at, h, n)
            met = np.flatnonzero(self.words[self._bit(h)])
            place = np.minimum(np.searchsorted(self.hashes, h[met]), max(len(self.hashes) - 1, 0))
            same = (self.hashes[place] == h[met]) & (self.sizes[place] == n)
            met, place = met[same], place[same]
            for j in range(n):
                same = points[at[met] + j] == self.points[self.first[place] + j]
                if not same.all():
                    met, place = met[same], place[same]
            found.append((at[met], np.full(len(met), n), self.costs[place]))
            open_ = self.begun[self._bit(h)]
            at, h = at[open_], h[open_]
        if not found:
            return [[] for _ in texts]
        begin, size, cost = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(begin, kind="stable")
        begin, size, cost = begin[order], size[order], cost[order]
        row = np.searchsorted(starts, begin, "right") - 1
        cuts = np.searchsorted(row, np.arange(len(texts) + 1))
        listed = list(zip((begin - starts[row]).tolist(), size.tolist(), cost.tolist(), strict=True))
        return [listed[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def best_path(n: int, ending: dict[int, list[tuple[int, int]]], unknown: int) -> list[int]:
    """Ends of the words on the cheapest path over 0..n; ``ending`` has (length, cost) by the end of a word.

    Any single character may stand alone at ``unknown``.  Equal costs go to fewer words, then to the longer last word.
    """
    costs, words, sizes = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for end in range(1, n + 1):
        cost, count, size = costs[end - 1] + unknown, words[end - 1] + 1, 1
        for k, c in ending.get(end, ()):
            if k <= end and (c := c + costs[end - k]) <= cost:
                w = words[end - k] + 1
                if c < cost or w < count or (w == count and k > size):
                    cost, count, size = c, w, k
        costs[end], words[end], sizes[end] = cost, count, size
    ends, at = [], n
    while at:
        ends.append(at)
        at -= sizes[at]
    return ends[::-1]


def words_of(text: str, hits: list[tuple[int, int, int]], unknown: int, whole: bool = False) -> list[str]:
    """Tokens of ``text``: split at white space, and runs of CJK characters (or, if ``whole``, everything) by their best
    path through ``hits`` (start, length, cost)."""
    pattern = _ALL if whole else _CJK
    starts = sorted(hits)
    out: list[str] = []
    k = done = 0
    for run in pattern.finditer(text):
        a, z = run.span()
        out += text[done:a].split()
        ending: dict[int, list[tuple[int, int]]] = {}
        while k < len(starts) and starts[k][0] < z:
            at, size, cost = starts[k]
            if at >= a and at + size <= z:
                ending.setdefault(at + size - a, []).append((size, cost))
            k += 1
        last = a
        for end in best_path(z - a, ending, unknown):
            out.append(text[last : a + end])
            last = a + end
        done = z
    return out + text[done:].split()


def _cut(texts: list[str], lattices: list[Lattice], unknown: int, whole: bool) -> pa.Array:
    """The words of each text, joined by blanks (no word holds one): an array of words takes several times the bytes."""
    out = []
    for lo, hi in places.parts(texts, PART):
        own = texts[lo:hi]
        for t, *hits in zip(own, *(x.hits(own) for x in lattices), strict=True):
            out.append(" ".join(words_of(t, [h for listed in hits for h in listed], unknown, whole)))
    return pa.array(out, pa.string())


def _cutting(sent: Broadcast, unknown: int, whole: bool):
    """Rows (key..., text) to (key..., tokens) by a lattice that every worker has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = _cut(b.column(b.num_columns - 1).to_pylist(), [sent.value], unknown, whole)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], tokens], [*b.schema.names[:-1], "tokens"])

    return run


# ---- dictionaries too long to broadcast -----------------------------------


def _again(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _marked(bits: tuple[int, int]):
    """(kind, part, bit): what the beginnings of each word (kind 0) and the words (kind 1) set in their filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, starts = places.codes(b.column(0).to_pylist())
            first, sizes = starts[:-1], np.diff(starts) - 1
            ids, h, n = np.arange(len(first)), np.ones(len(first), np.uint64), 0
            at: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
            while len(ids):
                n += 1
                h = Lattice._grow(points, first[ids], h, n)
                last = sizes[ids] == n
                at[1].extend(x for k in (h[last], _again(h[last])) for x in places.Beginnings.places(k, bits[1]))
                ids, h = ids[~last], h[~last]
                at[0].extend(places.Beginnings.places(h, bits[0]))
            for kind in (0, 1):
                set_ = np.unique(np.concatenate([np.zeros(0, np.int64), *at[kind]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(set_), kind)), pa.array(set_ // places.PART), pa.array(set_ % places.PART)], ["kind", "part", "bit"])

    return run


def _filters(words: DataFrame) -> tuple[places.Beginnings, places.Beginnings]:
    """Bloom filters of the words' beginnings of every length and of the words: 64 MiB at most reach the driver."""
    m = words.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("word")), F.lit(0)).alias("chars")).first()
    bits = places.Beginnings.bits_for(m["chars"]), places.Beginnings.bits_for(2 * m["n"])
    data = [np.zeros(max(places.PART, 1 << b) // 8, np.uint8) for b in bits]
    marks = words.select("word").mapInArrow(_marked(bits), "kind long, part long, bit long")
    for r in marks.groupBy("kind", "part").agg(F.bitmap_construct_agg("bit").alias("map")).collect():
        data[r["kind"]][r["part"] * (places.PART // 8) :][: places.PART // 8] = np.frombuffer(r["map"], np.uint8)
    return places.Beginnings(bits[0], data[0], ()), places.Beginnings(bits[1], data[1], ())


def may_hold(begun: places.Beginnings, known: places.Beginnings, texts: list[str]) -> set[str]:
    """The different words that pass the filters, wherever they stand in the texts."""
    points, _ = places.codes(texts)
    line = "\n".join([*texts, ""])
    found: set[str] = set()
    at, h, n = np.arange(len(points)), np.ones(len(points), np.uint64), 0
    while len(at):
        n += 1
        inside = at + n <= len(points)
        at, h = at[inside], h[inside]
        h = Lattice._grow(points, at, h, n)
        met = np.flatnonzero(known.has(h))
        met = met[known.has(_again(h[met]))]
        found.update(line[i : i + n] for i in at[met].tolist())
        open_ = begun.has(h)
        at, h = at[open_], h[open_]
    return found


def _sending(sent: Broadcast):
    """The texts of a block to ``(_block, word)``, one row for each different word that may stand in them."""

    def run(block: pa.Table) -> pa.Table:
        texts = block.column("_t").to_pylist()
        found = sorted(set().union(*(may_hold(*sent.value, texts[lo:hi]) for lo, hi in places.parts(texts, PART))))
        return pa.table({"_block": pa.array([block.column("_block")[0].as_py()] * len(found), pa.int64()), "word": pa.array(found, pa.string())})

    return run


def _cutting_block(sent: Broadcast, unknown: int, whole: bool):
    """The texts of a block and its seldom words to (key..., tokens)."""

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        own = Lattice.of(words.column("word").to_pylist(), words.column("cost").to_numpy())
        tokens = _cut(block.column("_t").to_pylist(), [sent.value, own], unknown, whole)
        return block.drop_columns(["_t", "_block"]).append_column("tokens", tokens)

    return run


def _by_blocks(keyed: DataFrame, seldom: DataFrame, often: Broadcast, key: list[str], kinds: str, unknown: int, whole: bool) -> DataFrame:
    """Texts are dealt into blocks; a block asks once for each seldom word that may stand in it, and is cut with the answers.

    So a word that stands everywhere costs a row for each block, and no place of a text is ever shuffled.
    """
    asked = keyed.sparkSession.sparkContext.broadcast(_filters(seldom))
    size = keyed.agg(F.coalesce(F.sum(F.length("_t") + 16), F.lit(0)).alias("n")).first()["n"]
    placed = keyed.withColumn("_block", F.pmod(F.xxhash64(*key, "_t"), F.lit(max(1, -(-size // BLOCK))).cast("long")))
    words = placed.groupBy("_block").applyInArrow(lambda b: _sending(asked)(b), "_block long, word string")
    priced = words.join(seldom.select("word", "cost"), "word").select("_block", "word", "cost")
    both = placed.groupBy("_block").cogroup(priced.groupBy("_block"))
    return both.applyInArrow(lambda b, w: _cutting_block(often, unknown, whole)(b, w), f"{kinds}, tokens string")


def segmented(rows: DataFrame, text: Column, dictionary: Dictionary, out: str, key: list[str], whole: bool = False) -> DataFrame:
    """``rows`` with the array ``out``: the words of ``text`` by the dictionary.

    White space always parts words.  Runs of CJK characters are cut by the cheapest path through the lattice of all
    dictionary words in them; other text stays as it is, unless ``whole`` asks to cut everything.  A dictionary that was
    measured small goes to every worker, which cuts the texts where they stand.  Of a larger one the most frequent words do,
    and the others come to the blocks of texts in which they may stand, so any size will do.  A null text has no words.
    ``key`` must name a row.
    """
    workers.prepare(rows.sparkSession)
    keyed = rows.select(*key, F.coalesce(text, F.lit("")).alias("_t"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:-1])
    unknown = dictionary.unknown
    often, seldom = (dictionary.costs, None) if dictionary.lexicon.small else by_frequency(dictionary.costs, "n")
    listed = often.select("word", "cost").toArrow()
    lattice = Lattice.of(listed["word"].to_pylist(), listed["cost"].to_numpy())
    sent = rows.sparkSession.sparkContext.broadcast(lattice)
    if seldom is None:
        tokens = keyed.mapInArrow(lambda b: _cutting(sent, unknown, whole)(b), f"{kinds}, tokens string")
    else:
        tokens = _by_blocks(keyed, seldom, sent, key, kinds, unknown, whole)
    joined = F.when(F.col("_joined") == "", F.array().cast("array<string>")).otherwise(F.split("_joined", " "))
    return rows.join(tokens.withColumnRenamed("tokens", "_joined"), key, "left").withColumn(out, joined).drop("_joined")
