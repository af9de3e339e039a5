"""Phrase collocation mining by Rabin-Karp fingerprints.

Words are hashed by differences of a prefix polynomial over the bytes of a batch, n-grams by a second one over the word
hashes, all in numpy.  For k = 1, 2, ... one pass counts the k-grams whose (k-1)-grams can be frequent (a bitmap of the
frequent fingerprints, at most 32 MiB, tells; it lets some others through and loses none), and the shuffle adds up
(language, fingerprint, count).  Each task keeps a pointer to one occurrence of every fingerprint.  A last pass follows
the pointers of the fingerprints that are frequent: every occurrence is compared with the text behind its pointer (those
that differ count under their own), and the shuffle adds up by text.  So collisions are split exactly, and no other phrase
ever becomes text.

Defined results: a null text is an empty one and has no words; a null language is ``und``; repeated rows count each time;
equal scores are ordered by a and then by the bytes of the phrase; an empty table gives no rows; extra columns are not
read.  Long texts are hashed in windows of 512 KiB (a single longer word stands in one window).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.llm.common import prepare, slices, stored
from corpuswash.plans.scale import skew_join

UNKNOWN = "und"
BLANKS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
WINDOW = 1 << 19
#: Bytes of text hashed at a time.
SLICE = 2 << 20
#: Distinct fingerprints held before they are handed on, and bytes of text read before phrases are.
HELD, HELD_BYTES = 2_000_000, 6 << 20
#: Longer phrases are joined one by one.
LONG = 1000
#: Bits per frequent fingerprint and the largest bitmap.
BITS_EACH, MOST_BITS = 16, 28
MAP_BITS = 32768
#: Candidates that one task ranks, about.
RANK_ROWS = 10_000

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(max(n, 1), b, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        have = _POWERS[base] = (out[0], out[1])
    return have


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _ranges(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of ``values`` (uint64), from one prefix polynomial; the place of a range does not matter."""
    power, inverse = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return _mixed((prefix[ends] - prefix[starts]) * inverse[starts])


@dataclass
class Words:
    """The words of some texts: lower-cased bytes, places, piece number and hash of each word."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(texts: list[str], window: int = WINDOW) -> Words:
        code = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        starts, ends, pieces, values = [], [], [], []
        low, at, seen = np.empty_like(code), 0, 0
        while at < len(code):
            to = min(at + window, len(code))
            while to < len(code) and _KIND[code[to - 1]] == 0:  # a window ends behind a word
                more = np.flatnonzero(_KIND[code[to : to + window]])
                to = to + int(more[0]) + 1 if len(more) else min(to + window, len(code))
            own = low[at:to] = _LOWER[code[at:to]]
            kind = _KIND[own]
            edge = np.flatnonzero(np.diff((kind == 0).view(np.int8), prepend=0, append=0))
            s, e, breaks = edge[::2], edge[1::2], np.flatnonzero(kind == 2)
            values.append(_ranges(own.astype(np.uint64) + np.uint64(1), _BYTE_BASE, s, e))
            starts.append(s + at), ends.append(e + at), pieces.append(np.searchsorted(breaks, s) + seen)
            at, seen = to, seen + len(breaks)
        none = np.zeros(0, np.int64)
        join = lambda x, empty=none: np.concatenate(x) if x else empty
        return Words(low.tobytes(), join(starts), join(ends), join(pieces), join(values, none.astype(np.uint64)))

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of every k-gram inside a piece."""
        first = np.arange(max(0, len(self) - k + 1))
        first = first[self.piece[first] == self.piece[first + k - 1]]
        return first, self.value[first] if k == 1 else _ranges(self.value, _WORD_BASE + 2 * k, first, first + k)

    def hopeful(self, k: int, maps: list[Bitmap], salt: int) -> tuple[np.ndarray, np.ndarray]:
        """The k-grams all of whose shorter parts may be frequent, by the bitmaps of lengths 1, 2, ... below k."""
        first, fp = self.grams(k)
        if k > 1 and len(first):
            places, below = self.grams(k - 1)
            may = np.zeros(len(self) + 1, bool)
            may[places] = maps[k - 2].has(below, salt)
            keep = may[first] & may[first + 1]
            first, fp = first[keep], fp[keep]
        return first, fp

    def text(self, first: int, k: int) -> bytes:
        return b" ".join([self.raw[a:z] for a, z in zip(self.starts[first : first + k].tolist(), self.ends[first : first + k].tolist(), strict=True)])

    def texts(self, first: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """(places in ``first``, texts of the k-grams that begin there): those with one blank between words are copied
        together as they stand, the others and long ones are joined one by one."""
        size = self.ends[first + k - 1] - self.starts[first]
        words = sum(self.ends[first + j] - self.starts[first + j] for j in range(k))
        tight = (size == words + k - 1) & (size <= LONG)
        a, n = self.starts[first[tight]], size[tight]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out = np.frombuffer(self.raw, np.uint8)[np.repeat(a, n) + step]
        out[out == BLANKS[1]] = BLANKS[0]
        bounds = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        yield np.flatnonzero(tight), pa.StringArray.from_buffers(len(n), pa.py_buffer(bounds), pa.py_buffer(out))
        yield np.flatnonzero(~tight), pa.array([self.text(i, k).decode("utf-8", "surrogatepass") for i in first[~tight].tolist()], pa.string())

    def exact(self) -> np.ndarray:
        """A number for each word, equal where the *texts* are equal: hashes first, then all bytes are compared."""
        _, pointer, number = np.unique(self.value, return_index=True, return_inverse=True)
        there = pointer[number]
        size = self.ends - self.starts
        differ = size != size[there]
        raw, same = np.frombuffer(self.raw, np.uint8), np.flatnonzero(~differ)
        for at in range(0, len(same), 1 << 16):
            part = same[at : at + (1 << 16)]
            n = size[part]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            bad = raw[np.repeat(self.starts[part], n) + step] != raw[np.repeat(self.starts[there[part]], n) + step]
            differ[part[np.repeat(np.arange(len(part)), n)[bad]]] = True
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(differ).tolist():
            number[i] = others.setdefault(self.text(i, 1), len(pointer) + len(others))
        return number


@dataclass
class Bitmap:
    """Which fingerprints may be frequent; the language is mixed in."""

    bits: int
    data: np.ndarray

    def has(self, fp: np.ndarray, salt: int) -> np.ndarray:
        at = (fp ^ np.uint64(salt)) >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(frequent: DataFrame) -> Bitmap:
    """From (lang, fp), or from (fp) with the language mixed in: built by Spark in parts of 4 KiB; 32 MiB at most reach the
    driver, however many rows there are."""
    rows = frequent.count()
    bits = min(MOST_BITS, max(16, (BITS_EACH * rows - 1).bit_length()))
    mixed = F.col("fp").bitwiseXOR(F.xxhash64("lang")) if "lang" in frequent.columns else F.col("fp")
    at = F.shiftrightunsigned(mixed, 64 - bits)
    parts = frequent.select(at.alias("at")).groupBy(F.floor(F.col("at") / MAP_BITS).alias("part")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(MAP_BITS))).alias("map"))
    data = np.zeros(1 << (bits - 3), np.uint8)
    for r in parts.collect():
        data[r["part"] * (MAP_BITS // 8) :][: MAP_BITS // 8] = np.frombuffer(r["map"], np.uint8)
    return Bitmap(bits, data)


def _salt(lang: str) -> int:
    """Spark's ``xxhash64`` of the language."""
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    for whole in batches:
        for b in slices(whole, most=SLICE):
            per: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                per.setdefault(lang, []).append(text)
            yield from per.items()


def _counting(k: int, maps: list[Bitmap]) -> object:
    """(fp, c): k-grams of the task, added up; the language is mixed into the fingerprint, so that the shuffle adds up by one
    number (equal ones of two languages only let a phrase through to the pass that compares texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            fps, counts = (np.concatenate(x) for x in zip(*held[lang], strict=True))
            order = np.argsort(fps, kind="stable")
            fps, counts = fps[order], counts[order]
            new = np.flatnonzero(np.diff(fps, prepend=fps[:1] ^ np.uint64(1)))
            return fps[new], np.add.reduceat(counts, new) if len(new) else counts

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in held:
                fps, counts = merged(lang)
                fps = (fps ^ np.uint64(_salt(lang))).view(np.int64)
                for at in range(0, len(fps), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(fps[at : at + (1 << 16)]), pa.array(counts[at : at + (1 << 16)])], ["fp", "c"])
            held.clear()

        for lang, texts in _by_language(batches):
            words = Words.of(texts)
            _, fps = words.hopeful(k, maps, _salt(lang))
            fps, counts = np.unique(fps, return_counts=True)
            held.setdefault(lang, []).append((fps, counts.astype(np.int64)))
            size += len(fps)
            if size > HELD:
                for x in held:
                    held[x] = [merged(x)]
                size = sum(len(x[0][0]) for x in held.values())
                if size > HELD * 3 // 4:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _reading(most: int, maps: list[Bitmap], totals: bool = False) -> object:
    """(lang, phrase, c): the texts behind the pointers of frequent fingerprints, all occurrences compared; with
    ``totals`` the number of all words stands under the empty phrase."""

    def rows(lang: str, texts: list[str]) -> Iterator[pa.RecordBatch]:
        words, salt = Words.of(texts), _salt(lang)
        number = words.exact()
        if totals and len(words):
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([""], pa.string()), pa.array([len(words)], pa.int64())], ["lang", "phrase", "c"])
        for k in range(1, most + 1):
            first, fp = words.hopeful(k, maps, salt)
            keep = maps[k - 1].has(fp, salt)
            first, fp = first[keep], fp[keep]
            found, pointer, place, counts = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
            there = first[pointer][place]
            differ = np.zeros(len(first), bool)
            for j in range(k):
                differ |= number[first + j] != number[there + j]
            other = np.flatnonzero(differ)
            counts = counts - np.bincount(place[other], minlength=len(found))
            out_first, out_count = np.concatenate([first[pointer], first[other]]), np.concatenate([counts, np.ones(len(other), np.int64)])
            for at in range(0, len(out_first), 1 << 14):
                to = slice(at, at + (1 << 14))
                c = out_count[to].astype(np.int64)
                for places, phrases in words.texts(out_first[to], k):
                    if len(places):
                        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(places)), phrases, pa.array(c[places])], ["lang", "phrase", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size = 0
        for lang, texts in _by_language(batches):
            held.setdefault(lang, []).extend(texts)
            size += sum(map(len, texts))
            if size > HELD_BYTES:
                for x, t in held.items():
                    yield from rows(x, t)
                held, size = {}, 0
        for x, t in held.items():
            yield from rows(x, t)

    return run


def frequent_phrases(docs: DataFrame, most: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, f) of all phrases of 1 to ``most`` words with f >= ``least``, (lang, n) with all words)."""
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    maps: list[Bitmap] = []
    for k in range(1, most + 1):
        sent = spark.sparkContext.broadcast(maps)
        counted = source.mapInArrow(lambda b, k=k, sent=sent: _counting(k, sent.value)(b), "fp long, c long")
        # the tasks have added up what they hold, so the rows are dealt by fingerprint first and added up once
        counted = counted.repartition("fp").groupBy("fp").agg(F.sum("c").alias("f"))
        maps = [*maps, bitmap(stored(counted.where(F.col("f") >= least).select("fp")))]
    sent = spark.sparkContext.broadcast(maps)
    read = source.mapInArrow(lambda b: _reading(most, sent.value, totals=True)(b), "lang string, phrase string, c long")
    exact = stored(read.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == "")))
    found = exact.where("phrase <> ''").select("lang", F.size(F.split("phrase", " ")).alias("k"), "phrase", "f")
    return found, exact.where("phrase = ''").select("lang", F.col("f").alias("n"))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score): candidates by their lowest-scoring cut; whole numbers of up to 38 digits."""
    words = F.split("phrase", " ")
    candidates = phrases.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), words.alias("w"))
    cuts = candidates.select("lang", "k", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "k", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = stored(skew_join(cuts, part("first", "l"), ["lang", "first"], "inner", ["phrase", "cut"]))
    both = skew_join(both, part("rest", "r"), ["lang", "rest"], "inner", ["phrase", "cut"])
    score = F.expr("(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    best = both.withColumn("score", score).groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "k", "phrase", "a", "b.l", "b.r", F.col("b.score").cast("long").alias("score"))


def collocations(docs: DataFrame, most: int = 3, least: int = 10, share: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of 2 to ``most`` words of each language.

    A candidate goes if a longer one that contains it has at least ``share`` percent of its occurrences.
    """
    phrases, sizes = frequent_phrases(docs, most, least, text_col, lang_col)
    found = scored(phrases)
    w = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))))
    inside = phrases.where("k > 2").select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    alone = stored(found.join(inside, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {share} * a").drop("longer"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salts = max(1, -(-alone.count() // RANK_ROWS))
    parts = alone.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    for by in (["lang", "salt"], ["lang"]):  # the best of each part first, so that no language is one task
        parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return parts.join(F.broadcast(sizes) if sizes.count() < 100_000 else sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
