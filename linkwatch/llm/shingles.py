"""Word and shingle hashes of many texts at once, in numpy.

Words are runs of bytes without ASCII white space.  A word's hash is the sum of
a 64-bit value for each of its bytes, drawn by byte and place in the word, read
off prefix sums and mixed with the length.  No weight is a power of another, so
words whose polynomial hashes agree by construction have different ones; hashes
depend on the bytes alone, so every worker gets the same.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
STEP = _U(0xD1342543DE82EF95)

_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_mark = np.ones(256, bool)
_mark[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = False
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


# values of the first places of a word, by place and byte; later ones are computed
PLACES = 64
_drawn = mix(mix(np.arange(PLACES << 8, dtype=_U) + _U(0x9E3779B97F4A7C15)))


def _values(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    index = place << 8
    index |= raw
    if not len(index) or index.max() < PLACES << 8:
        return _drawn.take(index)
    far = index >= PLACES << 8
    out = _drawn.take(np.where(far, 0, index))
    out[far] = mix(mix(index[far].astype(_U) + _U(0x9E3779B97F4A7C15)))
    return out


class Words:
    """Words of a list of texts: hashes, byte spans and where each text's words start.

    ``data`` is all texts, each followed by a line feed; ``first[i] : first[i + 1]``
    are the words of text i.  ``plain`` splits at every ASCII mark too.
    """

    def __init__(self, texts: list[bytes | None], lower: bool = False, plain: bool = False):
        self.data = b"\n".join(t or b"" for t in texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        if lower:
            raw = _lower[raw]
        gap = (_mark if plain else _space)[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.r_[0, edge]
        self.start, self.end = edge[0::2], edge[1::2]
        # bytes of a gap get the place behind the word before it, their values are not used
        lead = int(self.start[0]) if len(self.start) else len(raw)
        kind = np.int32 if len(raw) < 1 << 22 else np.int64
        begins = np.r_[0, self.start].astype(kind)
        place = np.arange(len(raw), dtype=kind)
        place -= np.repeat(begins, np.diff(np.r_[begins, kind(len(raw))]))
        place[:lead] = 0
        sums = np.zeros(len(raw) + 1, _U)
        np.cumsum(_values(raw, place), out=sums[1:])
        self.hash = mix(sums[self.end] - sums[self.start] + mix((self.end - self.start).astype(_U)))
        lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        self.text_start = np.r_[0, np.cumsum(lengths)]
        self.first = np.searchsorted(self.start, self.text_start)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = words[:n].copy()
    for k in range(1, size):
        total *= STEP
        total += words[k : k + n]
    return mix(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, one without words has none."""
    if not len(words):
        return np.zeros(0, _U)
    return np.unique(windows(words, min(size, len(words))) + _U(min(size, len(words))))
