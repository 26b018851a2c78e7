"""Word shingles of whole texts as 64-bit hashes, computed on the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Fixed odd numbers: the base of the word hash and the factor of each place in a shingle.
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if _POWERS.get("n", 0) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = n
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each text's first word (with the end)."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last]
    offsets = offsets - first
    upper = (raw >= 65) & (raw <= 90)
    low = raw + (upper.view(np.uint8) << 5)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    border = np.zeros(len(raw) + 1, dtype=bool)  # a text begins or ends before this byte
    border[offsets] = True
    begin = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | border[:-1]))
    end = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | border[1:])) + 1
    up, down = powers(len(raw))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(low.astype(np.uint64) * up, dtype=np.uint64)))
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; a text of fewer words is one shingle, none without words."""
    words, starts = word_hashes(texts)
    n = len(words)
    if n >= WIDTH:
        rows = sum((words[j : n - WIDTH + 1 + j] * _PLACE[j] for j in range(1, WIDTH)), words[: n - WIDTH + 1] * _PLACE[0])
        rows = mix(rows)
    else:
        rows = np.empty(0, dtype=np.uint64)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= WIDTH:
            out.append(np.unique(rows[a : b - WIDTH + 1]))
        elif b > a:
            part = words[a:b] * _PLACE[: b - a]
            out.append(mix(np.array([part.sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64), mix(s ^ _M2).sum(dtype=np.uint64)], dtype="<u8").tobytes()
