"""Tokenizer ids of whole texts, with the ids of known pieces remembered in flat arrays.

The byte-level vocabulary's own splitting pattern begins a new piece at a single space or line feed between two non-blank
characters, and at a full stop or comma after a letter; so pieces cut there are encoded alone with the same result.  Texts
with other blanks, control characters or a special token's string are encoded whole.  The same cuts hold for a
sentencepiece vocabulary in which no piece goes on behind them, which is looked up when it is loaded.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of pieces that one worker remembers per tokenizer, about; when they are used up, pieces met again stay, in half the room.
MEMORY = 56 << 20
#: Pieces that the library is given in one text; longer texts leave the caches of the processor.
RUN = 500
#: Longer pieces are not remembered.
LONG = 400
_BLANKS = r"\x00-\x09\x0b-\x1f\x7f-\xa0\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}"

Flat = tuple[np.ndarray, np.ndarray]


class Memory:
    """Ids of pieces: one flat array with the start and the length of each piece, numbered in the order of arrival."""

    def __init__(self, encode: Callable[[list[str]], Flat], most: int = MEMORY) -> None:
        self.encode, self.most = encode, most
        self.place: dict[str, int] = {}
        self.base = self.count = self.used = self.bytes = 0  # pieces dropped; pieces, ids and bytes in use
        self.ids, self.start, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.cost, self.again = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, bool)  # bytes; whether met again since the last drop

    def _room(self, name: str, need: int) -> None:
        have = getattr(self, name)
        if need > len(have):
            more = np.zeros(max(need, 2 * len(have)), have.dtype)
            more[: len(have)] = have
            setattr(self, name, more)

    def _forget(self) -> None:
        """Drop the pieces that were not met again, and the older ones of the others if they take more than half the room."""
        stay = np.flatnonzero(self.again[: self.count])
        behind = np.cumsum(self.cost[stay][::-1], dtype=np.int64)[::-1]
        stay = stay[behind <= self.most // 2]
        n = len(stay)
        first, self.base = self.base, self.base + self.count - n
        number = np.full(self.count, -1)
        number[stay] = self.base + np.arange(n)
        now = number.tolist()
        self.place = {p: k for p, i in self.place.items() if (k := now[i - first]) >= 0}
        size = self.size[stay]
        last = np.cumsum(size, dtype=np.int64)
        self.used = int(last[-1]) if n else 0
        self.ids[: self.used] = self.ids[np.repeat(self.start[stay] - (last - size), size) + np.arange(self.used)]
        self.start[:n], self.size[:n], self.cost[:n], self.again[:n] = last - size, size, self.cost[stay], False
        self.count, self.bytes = n, int(self.cost[:n].sum(dtype=np.int64))

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size): the ids of piece i are ``ids[start[i] : start[i] + size[i]]``."""
        while self.bytes > self.most and self.count:
            self._forget()
        at = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        fresh = at < 0
        at -= self.base
        self.again[at[~fresh]] = True
        if fresh.any():
            missing = [pieces[i] for i in np.flatnonzero(fresh).tolist()]
            flat, sizes = self.encode(missing)
            n, new = self.count, len(missing)
            self._room("ids", self.used + len(flat))
            for name in ("start", "size", "cost", "again"):
                self._room(name, n + new)
            self.ids[self.used : self.used + len(flat)] = flat
            self.start[n : n + new] = self.used + np.cumsum(sizes) - sizes
            self.size[n : n + new] = sizes
            self.cost[n : n + new] = np.minimum(np.fromiter(map(len, missing), np.int64, new), LONG) + 130 + 4 * sizes
            self.again[n : n + new] = False
            at[fresh] = n + np.arange(new)
            self.place.update((p, self.base + n + i) for i, p in enumerate(missing) if len(p) <= LONG)
            self.count, self.used = n + new, self.used + len(flat)
            self.bytes += int(self.cost[n : n + new].sum(dtype=np.int64))
        return self.ids, self.start[at], self.size[at]


def cut(texts: list[str], odd: str) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(places of the texts that can be cut, distinct pieces, number of each piece in order, bounds of each such text)."""
    column = pa.array(texts, pa.large_string())
    strange = pc.match_substring_regex(column, odd).to_numpy(zero_copy_only=False) | (pc.binary_length(column).to_numpy() == 0)
    plain = np.flatnonzero(~strange)
    if not len(plain):
        return plain, [], np.zeros(0, np.int64), np.zeros(1, np.int64)
    marked = pc.replace_substring_regex(column.take(pa.array(plain)), r"(\pL)([.,])", "\\1\x01\\2")
    marked = pc.replace_substring(pc.replace_substring(marked, " ", "\x01 "), "\n", "\x01\n\x01")
    lists = pc.split_pattern(marked, "\x01")
    coded = lists.flatten().dictionary_encode()
    return plain, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64)


def gathered(ids: np.ndarray, start: np.ndarray, size: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces ``codes`` in order, and the bounds of each text among them."""
    length = size[codes].astype(np.int64)
    last = np.cumsum(length)
    total = int(last[-1]) if len(last) else 0
    place = np.repeat(start[codes] - (last - length), length) + np.arange(total)
    return ids[place], np.concatenate([[0], last])[bounds]


def byte_level_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others follow
    in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Byte-level BPE by the tokenizers library."""

    ODD = rf"[{_BLANKS}]|[ \n][ \n]|^[ \n]|[ \n]$|<\|"

    def __init__(self, path: str, specials_are_text: bool = False, most: int = MEMORY) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = specials_are_text
        self.feed = self.model.encode("\n", add_special_tokens=False).ids
        self.memory = Memory(self.pieces, most)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[str]) -> Flat:
        """Pieces without blanks inside are encoded ``RUN`` at a time with line feeds between and cut at these."""
        own = [p for p in pieces if p and p != "\n"]
        runs = [self.whole(["\n".join(own[i : i + RUN])])[0] for i in range(0, len(own), RUN)]
        feed = np.array(self.feed, np.uint32)
        ids = np.concatenate([x for run in runs for x in (feed, run)][1:]) if runs else np.zeros(0, np.uint32)
        return _parted(pieces, own, ids, self.feed, self.whole)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain, distinct, codes, bounds = cut(texts, self.ODD)
        out: list[np.ndarray | None] = [None] * len(texts)
        if len(plain):
            ids, at = gathered(*self.memory(distinct), codes, bounds)
            for k, i in enumerate(plain.tolist()):
                out[i] = ids[at[k] : at[k + 1]]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.whole([texts[i] for i in rest]), strict=True):
            out[i] = x
        return out  # type: ignore[return-value]

    def token_bytes(self) -> list[bytes]:
        table = byte_level_bytes()
        names = [self.model.id_to_token(i) for i in range(self.model.get_vocab_size(with_added_tokens=True))]
        return [bytes(table[c] for c in x) if x is not None and all(c in table for c in x) else (x or "").encode() for x in names]


def _parted(pieces: list[str], own: list[str], ids: np.ndarray, feed: list[int], whole: Callable[[list[str]], list[np.ndarray]]) -> Flat:
    """Ids and sizes of ``pieces`` from the ids of ``own`` joined by line feeds; one by one if the cuts do not fit."""
    marks = np.flatnonzero(ids == feed[0]) if len(feed) == 1 else np.zeros(0, np.int64)
    if len(marks) != max(0, len(own) - 1):
        each = whole(own)
        ids, sizes = np.concatenate(each), np.array([len(x) for x in each], np.int64)
    else:
        sizes = np.diff(marks, prepend=-1, append=len(ids)) - 1 if own else np.zeros(0, np.int64)
        ids = np.delete(ids, marks)
    if len(own) == len(pieces):
        return ids, sizes
    out, at, k = [], 0, 0  # at most two pieces of a batch are the empty one and the line feed
    size = np.zeros(len(pieces), np.int64)
    for i in [i for i, p in enumerate(pieces) if not p or p == "\n"]:
        n = i - k
        out.append(ids[at : at + int(sizes[:n].sum())])
        size[k : i] = sizes[:n]
        at, sizes = at + len(out[-1]), sizes[n:]
        if pieces[i]:
            out.append(np.array(feed, ids.dtype))
            size[i] = len(feed)
        k = i + 1
    out.append(ids[at:])
    size[k:] = sizes
    return np.concatenate(out), size


class SentencePiece:
    """A sentencepiece model; it puts a space before the text, which the texts and pieces here already hold."""

    ODD = rf"[{_BLANKS}\x{{2581}}]|[ \n][ \n]|^[^ ]|[ \n]$|<\|"

    def __init__(self, path: str, most: int = MEMORY) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = lambda a, b: (b == "\u2581" != a) or (b in ".," and unicodedata.category(a)[0] == "L")
        alone = not any("\n" in x or any(crossing(a, b) for a, b in pairwise(x)) for x in self.names)
        head = self.model.encode("\n")
        self.feed = head[1:]
        #: Whether cut pieces may be encoded alone.
        self.cuts = alone and len(head) == 2 and self.names[head[0]] == "\u2581" and self.model.encode("\nab") == head + self.model.encode("\nab")[2:]
        self.memory = Memory(self.pieces, most)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that begin with the space that the model puts there itself."""
        return [np.array(x, np.uint32) for x in self.model.encode([t[1:] for t in texts], num_threads=1)] if texts else []

    def _inner(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x[2:], np.uint32) for x in self.model.encode([f"\n{t}" for t in texts], num_threads=1)]

    def pieces(self, pieces: list[str]) -> Flat:
        own = [p for p in pieces if p and p != "\n"]
        ids = self._inner(["\n".join(own)])[0] if own else np.zeros(0, np.uint32)
        return _parted(pieces, own, ids, self.feed, self._inner)

    def token_bytes(self) -> list[bytes]:
        """A piece in UTF-8 with U+2581 as a space; byte pieces as their byte."""
        return [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("\u2581", " ").encode() for i, x in enumerate(self.names)]
