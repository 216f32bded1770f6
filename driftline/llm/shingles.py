"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Words hash by a polynomial modulo 2**64 and a mixer,
shingles by the hashes of their words; that two different shingles of a comparison share a hash has odds near 2**-44.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (BASE, INVERSE)]
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[str | None]):
    """Runs of texts of about ``CHUNK`` bytes, as (first index, encoded texts)."""
    at, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append((t or "").encode())
        n += len(held[-1])
        if n >= CHUNK:
            yield at, held
            at, held, n = i + 1, [], 0
    if held:
        yield at, held


def word_hashes(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words, number of words before each text and in all, byte starts, byte ends) of a run of texts.

    Byte places are those in the texts joined by one byte.
    """
    raw = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    word = np.zeros(len(raw) + 2, bool)
    word[1:-1] = ~BLANK[raw]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    forward, back = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * forward[:len(raw)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * back[starts])
    firsts = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    return hashes, np.searchsorted(starts, firsts), starts, ends


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, as many as there are words less ``width`` - 1."""
    n = max(0, len(words) - width + 1)
    out = words[:n].copy()
    for k in range(1, width):
        out = mixed(out * np.uint64(BASE) + words[k:k + n])
    return out


def sets(texts: list[str | None], width: int):
    """Sorted distinct shingle hashes of each text: a text of fewer words is one shingle, one without words has none."""
    for _, encoded in chunks(texts):
        words, firsts, _, _ = word_hashes(encoded)
        runs = rolling(words, width)
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b - a >= width:
                got = np.sort(runs[a:b - width + 1])
                yield got[np.concatenate([[True], got[1:] != got[:-1]])]
            else:
                yield rolling(words[a:b], b - a) if b > a else np.empty(0, np.uint64)
