"""Words of many texts at once, as numbers: vectorised splitting, hashing and n-grams.

A word is a maximal run of letters after Unicode NFC, in lower case; everything else separates. With ``fold`` diacritics
are dropped too (and the barred d counts as d), so that spelling variants meet. Null and empty texts have no words.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Characters handled in one vectorised step; a longer text makes a step of its own.
STEP_CHARS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers can be undone
_GRAM = np.uint64(0xC2B2AE3D27D4EB4F)
_MARK = 0xFFFFFFFF


class Words(NamedTuple):
    """``key``: 64-bit hash of each word; ``first``: for each text the index of its first word, and the total at the end."""

    key: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def inverse(odd: int) -> int:
    """The number that undoes a multiplication by ``odd`` modulo 2**64."""
    return pow(odd, -1, 1 << 64)


@lru_cache(maxsize=4)
def powers(odd: int, n: int) -> np.ndarray:
    out = np.full(n, odd, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers_for(odd: int, n: int) -> np.ndarray:
    """At least ``n`` powers; sizes are rounded up so that few arrays are made."""
    return powers(odd, 1 << max(16, int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def letters(fold: bool) -> np.ndarray:
    """For every code point its lower-case letter, 0 for what separates, and with ``fold`` a mark for what is dropped."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            if fold:
                base = unicodedata.normalize("NFD", c)
                if len(base) > 1 and all(unicodedata.combining(x) for x in base[1:]):
                    c = base[0]
            low = c.lower()
            table[code] = ord(low[0])
        elif fold and unicodedata.category(c) == "Mn":
            table[code] = _MARK
    if fold:
        for c in "đĐ":
            table[ord(c)] = ord("d")
    return table


def _normal(text: str | None) -> str:
    if not text:
        return ""
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def split(texts: list[str | None], fold: bool = False) -> Words:
    """The words of ``texts``, in order."""
    clean = [_normal(t) for t in texts]
    codes = np.frombuffer("\n".join([*clean, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in clean), np.int64, len(clean)))
    low = letters(fold)[codes]
    if fold:
        kept = low != _MARK
        ends = np.concatenate([[0], np.cumsum(kept)])[ends]
        low = low[kept]
    edge = np.diff(np.concatenate([[False], low != 0, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.empty(len(low) + 1, np.uint64)
    total[0] = 0
    np.cumsum(low * powers_for(int(_BASE), len(low) + 1)[: len(low)], out=total[1:])
    key = mix((total[end] - total[start]) * powers_for(inverse(int(_BASE)), len(low) + 1)[start])
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return Words(key, first)


def grams(key: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words that begin at each word (``len(key) - n + 1`` of them; none if there are fewer words)."""
    if len(key) < n:
        return np.empty(0, np.uint64)
    total = np.empty(len(key) + 1, np.uint64)
    total[0] = 0
    np.cumsum(key * powers_for(int(_GRAM), len(key) + 1)[: len(key)], out=total[1:])
    return mix((total[n:] - total[:-n]) * powers_for(inverse(int(_GRAM)), len(key) + 1)[: len(key) - n + 1])


def steps(texts: list[str | None], most: int = STEP_CHARS):
    """Ranges ``(from, to)`` of ``texts`` with about ``most`` characters each."""
    begin = held = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n + 1
    if begin < len(texts):
        yield begin, len(texts)
