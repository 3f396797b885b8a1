"""Words of texts as 64-bit hashes, all words of many texts at once, and Rabin-Karp hashes of word windows."""

from __future__ import annotations

import numpy as np

from tallystone.llm.common import mix64, WHITE

#: Multiplier of the Rabin-Karp polynomial over the integers modulo 2^64 (odd).
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Another one, for a second hash that tells apart what has the same first one.
OTHER = np.uint64(0xD1342543DE82EF95)
#: Bytes whose words are hashed at once.
SLICE = 1 << 18
_DARK = np.array([chr(c) not in WHITE for c in range(256)])
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * BASE)
_LOWER = _BYTE[[c + 32 if 65 <= c <= 90 else c for c in range(256)]]


def _multipliers(n: int) -> np.ndarray:
    """A random odd number for each place in a word; kept, as long as the longest word so far (8 bytes a place)."""
    if len(_PLACES[0]) < n:
        _PLACES[0] = mix64(np.arange(1 << (n - 1).bit_length(), dtype=np.uint64) + BASE) | np.uint64(1)
    return _PLACES[0]


_PLACES = [np.empty(0, np.uint64)]


def hashed(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the texts, one text after another, and the place at which each text's words begin (and the
    end). A word's hash is the sum of its bytes' random numbers, each times that of its place, mixed with its length.
    Words are parted by ASCII white space; lower: A-Z count as a-z."""
    data = b" ".join([b"", *(t or b"" for t in texts), b""])
    raw = np.frombuffer(data, np.uint8)
    dark = _DARK[raw]
    edge = np.flatnonzero(dark[1:] != dark[:-1]) + 1
    first, stop = edge[::2], edge[1::2]
    ends = np.searchsorted(first, np.cumsum([1, *(len(t or b"") + 1 for t in texts)]))
    if not len(first):
        return np.empty(0, np.uint64), ends
    numbers, places = _LOWER if lower else _BYTE, _multipliers(int((stop - first).max()))
    cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, len(raw), SLICE)), len(first)))
    out = np.empty(len(first), np.uint64)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        length = stop[i:j] - first[i:j]
        at = np.cumsum(length) - length
        place = np.arange(at[-1] + length[-1]) - np.repeat(at, length)
        own = slice(first[i], stop[j - 1])
        with np.errstate(over="ignore"):
            value = numbers[raw[own][dark[own]]] * places[place]
            out[i:j] = mix64(np.add.reduceat(value, at) + length.astype(np.uint64) * BASE)
    return out, ends


def windows(hashes: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of each run of `width` consecutive words: sum of hash * base^place, mixed."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        value = hashes[:n].copy()
        for j in range(1, width):
            value *= base
            value += hashes[j : j + n]
        return mix64(value + np.uint64(width))


def runs(texts: list[bytes | None], limit: int = 1 << 18) -> list[list[bytes | None]]:
    """The texts in runs of about `limit` bytes, so that few words are held at once."""
    out, size = [[]], 0
    for text in texts:
        if size >= limit:
            out.append([])
            size = 0
        out[-1].append(text)
        size += len(text or b"")
    return out
