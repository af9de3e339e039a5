"""Phrases that stand several times in a row, of any length, in n log n steps.

``times`` copies of a phrase of ``u`` characters are a stretch in which each character equals the one ``u`` further on.
Such a stretch holds ``times`` multiples of ``u``, so comparing the text with itself at multiples only finds all units that
can repeat (n/1 + n/2 + ... comparisons, all in numpy); for the few that pass, the maximal stretches are read off exactly.
"""

from __future__ import annotations

import re

import numpy as np

#: Comparisons made at a time.
STEP = 2_000_000
_SHORT = 40
_QUICK = re.compile(r"(.+?)\1{3}", re.S)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def units(c: np.ndarray, least: int, most: int, times: int) -> np.ndarray:
    """Units between ``least`` and ``most`` that may stand ``times`` times in a row; no other unit does."""
    n, found = len(c), []
    while least <= most:
        # as many units at once as make STEP comparisons
        upto = least
        while upto < most and (upto - least + 1) * n / least < STEP:
            upto = min(most, 2 * upto)
        u = np.arange(least, upto + 1)
        count = np.maximum((n - 1) // u - times + 2, 0)
        unit = np.repeat(u, count)
        at = (np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count)) * unit
        for k in range(times - 1):
            same = c[at + k * unit] == c[at + (k + 1) * unit]
            unit, at = unit[same], at[same]
        if times > 2:  # the stretch reaches over the whole first unit
            for part in (2, 3, 5, 7):
                there = at + unit // part
                same = c[there] == c[there + unit]
                unit, at = unit[same], at[same]
        found.append(np.unique(unit))
        least = upto + 1
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def stretches(c: np.ndarray, unit: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the maximal stretches that hold ``times`` copies: places equal to the one a unit on."""
    edge = np.flatnonzero(np.diff((c[:-unit] == c[unit:]).view(np.int8), prepend=0, append=0))
    first, length = edge[::2], edge[1::2] - edge[::2]
    keep = length >= (times - 1) * unit
    return first[keep], length[keep]


def reduced(text: str) -> str:
    """For unit length 1, 2, ... while 4 * unit < length: more than three copies in a row are cut to three.

    Each cut changes the text before the next unit is looked at.  All copies are cut that have three more behind them.
    """
    if len(text) < 5 or (len(text) <= _SHORT and not _QUICK.search(text)):
        return text
    c, last, changed = points_of(text), 0, False
    while True:
        for u in units(c, last + 1, (len(c) - 1) // 4, 4).tolist():
            first, length = stretches(c, u, 4)
            if len(first):
                keep = np.ones(len(c), bool)
                for a, n in zip(first.tolist(), length.tolist(), strict=True):
                    keep[a : a + ((n - 3 * u) // u + 1) * u] = False
                c, last, changed = c[keep], u, True
                break
        else:
            return c.tobytes().decode("utf-32-le", "surrogatepass") if changed else text


def repeats(text: str, times: int, length: int) -> bool:
    """Whether a phrase longer than ``length`` stands ``times`` times in a row."""
    c = points_of(text)
    return any(len(stretches(c, u, times)[0]) for u in units(c, length + 1, len(c) // times, times).tolist())
