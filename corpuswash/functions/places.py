"""Places of a text at which a word of a lexicon may begin, in Arrow batches and numpy.

The words' beginnings stand in a Bloom filter of bounded size.  All texts of a batch are hashed at every position at once,
and only positions whose beginning passes the filter leave the scan; whole words are compared afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bits per word and the largest filter (32 MiB); two bits are set and tested per word.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 10, 28
#: Characters hashed at a time.
WINDOW = 1 << 20
_BASE, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one separator, and the place of each text's first one."""
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    return np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4"), starts


def hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` code points from each place; the last n - 1 places have none."""
    size = max(0, len(points) - n + 1)
    h = np.zeros(size, np.uint64)
    for j in range(n):
        h *= _BASE
        h += points[j : j + size]
        h ^= h >> np.uint64(31)
    h *= _SPREAD
    return h ^ (h >> np.uint64(29))


@dataclass(frozen=True)
class Beginnings:
    """Bloom filter of the first ``lens`` characters of words; a word is listed under the longest length it has."""

    bits: int
    data: np.ndarray
    lens: tuple[int, ...]

    @staticmethod
    def bits_for(rows: int) -> int:
        return min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * max(1, rows) - 1).bit_length()))

    @staticmethod
    def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        second = (h * _SPREAD) >> np.uint64(64 - bits)
        return (h >> np.uint64(64 - bits)).astype(np.int64), second.astype(np.int64)

    def has(self, h: np.ndarray) -> np.ndarray:
        a, b = self.places(h, self.bits)
        found = self.data[a >> 3] >> (a & 7).astype(np.uint8) & 1 == 1
        some = np.flatnonzero(found)
        found[some] = self.data[b[some] >> 3] >> (b[some] & 7).astype(np.uint8) & 1 == 1
        return found

    def scan(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length of the beginning, number of the text, position) of all places that pass."""
        points, starts = codes(texts)
        for n in self.lens:
            open_ = np.ones(len(points), bool)  # no window reaches over the end of its text
            for j in range(n):
                open_[np.maximum(starts[1:] - 1 - j, 0)] = False
            for at in range(0, len(points), WINDOW):
                h = hashes(points[at : at + WINDOW + n - 1], n)
                passed = np.flatnonzero(self.has(h) & open_[at : at + len(h)]) + at
                row = np.searchsorted(starts, passed, "right") - 1
                yield n, row, passed - starts[row]


def whole_words(found: Beginnings, whole: Beginnings, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(number of the text, position, length) of the places that pass, for each length at which a whole word passes too."""
    points, starts = codes(texts)
    for least, row, at in found.scan(texts):
        begin, h = starts[row] + at, np.zeros(len(row), np.uint64)
        end = starts[row + 1] - 1
        most = least if least < max(found.lens) else max(whole.lens)  # shorter beginnings are words
        for n in range(1, most + 1):
            inside = begin + n <= end  # no word reaches over the end of its text
            if not inside.all():
                row, begin, end, h = row[inside], begin[inside], end[inside], h[inside]
            if not len(row):
                break
            h = (h * _BASE) + points[begin + n - 1]
            h ^= h >> np.uint64(31)
            if n >= least and n in whole.lens:
                mixed = h * _SPREAD
                own = np.flatnonzero(whole.has(mixed ^ (mixed >> np.uint64(29))))
                yield row[own], begin[own] - starts[row[own]], n


def beginning_hashes(prefixes: list[str]) -> np.ndarray:
    """Hashes of strings that are looked up as a whole."""
    out = np.zeros(len(prefixes), np.uint64)
    sizes = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        points, starts = codes([prefixes[i] for i in own.tolist()])
        out[own] = hashes(points, int(n))[starts[:-1]]
    return out


def marked(bits: int):
    """(part, bit): the bits that each beginning sets, as parts of ``PART`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(Beginnings.places(beginning_hashes(b.column(0).to_pylist()), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at // PART), pa.array(at % PART)], ["part", "bit"])

    return run


PART = 32768


def candidates(found: Beginnings, ahead: int, whole: Beginnings | None = None):
    """Rows (key..., text) to (key..., n, at, ahead): places that pass, with up to ``ahead`` characters from there.

    With ``whole``, a filter of whole words (of their first ``ahead`` characters), a place comes once for each length ``n``
    at which it passes, and carries so many characters.
    """

    def passed(own: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if whole is None:
            yield from found.scan(own)
        else:
            yield from ((n, row, at) for row, at, n in whole_words(found, whole, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.schema.names[:-1]
            texts = b.column(len(keys)).to_pylist()
            for lo, hi in parts(texts):
                own = texts[lo:hi]
                for n, row, at in passed(own):
                    most = ahead if whole is None else n
                    for k in range(0, len(row), 1 << 15):
                        r, p = row[k : k + (1 << 15)], at[k : k + (1 << 15)]
                        cut = [own[i][j : j + most] for i, j in zip(r.tolist(), p.tolist(), strict=True)]
                        taken = [b.column(c).take(pa.array(r + lo)) for c in range(len(keys))]
                        yield pa.RecordBatch.from_arrays([*taken, pa.array(np.full(len(r), n, np.int32)), pa.array(p.astype(np.int32)), pa.array(cut, pa.string())], [*keys, "n", "at", "ahead"])

    return run


def parts(texts: list[str], most: int = 4 * WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    first = total = 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > most:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)
