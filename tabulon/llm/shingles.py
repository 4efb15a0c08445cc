"""Word shingles of whole texts as sorted 64-bit hashes, computed with numpy over a batch of texts.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A document's set holds its
distinct shingles of five words; a document of fewer words has its whole sequence
as its only shingle, one without words has none. Sets are compared by hashes.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_SEED = 20240611


def _odd(rng: np.random.Generator, n: int | None = None) -> np.ndarray:
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_RNG = np.random.default_rng(_SEED)
_BYTE = _odd(_RNG, 256)
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(_odd(_RNG))
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _odd(_RNG, WIDTH)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing steps of a common public hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out[:n]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and each text's number of words.

    ``data``: the bytes of all texts one after the other, each followed by a blank;
    ``ends``: the place after each text's blank.
    """
    blank = _BLANK[data]
    inside = ~blank
    begin = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(blank & np.concatenate([[False], inside[:-1]]))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    back = powers(_INVERSE, len(data))
    words = mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    upto = np.searchsorted(begin, ends)
    return words, np.diff(upto, prepend=0)


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, ascending within each text, and each text's number of them."""
    coded = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    ends = np.cumsum([len(c) + 1 for c in coded])
    words, n = word_hashes(data, ends)
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.cumsum(n) - n
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + first[doc]
    total = np.zeros(len(doc), np.uint64)
    short = (n < width)[doc]
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        value = padded[start + k] * _PLACE[k]
        if short.any():
            value[short & (k >= n[doc])] = 0
        total += value
    total = mixed(total + np.where(short, n[doc], width).astype(np.uint64))
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[keep], np.bincount(doc[keep], minlength=len(texts))
